"""Trips of a month, their gaps filled, rolled up per driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.dates import as_timestamp, in_month, month_start
from tarmac.functions.numbers import share_of, stable
from tarmac.schemas import DRIVER_KEYS, LATE_DRIVE, TRIP_MEASURES


def newest_trip(trips: DataFrame, tie_breaks: Sequence[str] = ()) -> DataFrame:
    """The trip that ended last."""
    ended = trips.withColumn("end_ts_cast", as_timestamp(trips, "end_ts"))
    order = [F.col("end_ts_cast").desc_nulls_last(), *[F.col(c).desc() for c in tie_breaks]]
    return ended.orderBy(*order).limit(1)


def trips_of_month(trips: DataFrame, month: str) -> DataFrame:
    """Trips that both start and end in the month."""
    parsed = trips.withColumn("start_ts_parsed", as_timestamp(trips, "start_ts")).withColumn(
        "end_ts_parsed", as_timestamp(trips, "end_ts")
    )
    return parsed.filter(
        in_month(F.col("start_ts_parsed"), month) & in_month(F.col("end_ts_parsed"), month)
    )


def cohort_trips(cohort: DataFrame, month_trips: DataFrame) -> DataFrame:
    """One row per cohort member and trip of its device user."""
    return cohort.join(month_trips, "sentiance_id", "inner")


def fill_gaps(cohort: DataFrame, month_trips: DataFrame) -> DataFrame:
    """One row per cohort member and trip, every missing measure replaced.

    A missing measure takes the driver's mean, else the mean over all rows,
    else 0; a missing late-drive flag counts as a late drive. All means come
    from sums per device user, and the gaps are filled before the cohort
    multiplies the trips. The sums are joined back rather than windowed, so
    that a user with a third of all trips can be split.
    """
    sums = driver_sums(month_trips)
    overall = mean_over_cohort(cohort.join(sums, "sentiance_id", "inner"))
    with_means = month_trips.join(
        sums.select("sentiance_id", *[own_mean(c).alias(f"{c}_mean") for c in TRIP_MEASURES]),
        "sentiance_id",
        "left",
    ).withColumn("_overall", overall.scalar())
    filled = with_means.select(
        "sentiance_id",
        *[
            F.coalesce(
                F.col(c), F.col(f"{c}_mean"), F.col("_overall")[c], F.lit(0.0)
            ).alias(c)
            for c in TRIP_MEASURES
        ],
        F.coalesce(F.col(LATE_DRIVE), F.lit(1)).alias(LATE_DRIVE),
    )
    return cohort_trips(cohort.select(*DRIVER_KEYS), filled).select(
        *DRIVER_KEYS, *TRIP_MEASURES, LATE_DRIVE
    )


def with_late_ratio(features: DataFrame) -> DataFrame:
    averages = ["avg_hard_accel", "avg_hard_brake", "avg_legal", "avg_overall_score"]
    ratio = share_of(F.col("total_late_drive_duration"), F.col("total_trip_duration"))
    return features.withColumns(
        {c: stable(F.col(c)) for c in averages} | {"late_drive_ratio": stable(ratio)}
    )


def driver_sums(month_trips: DataFrame) -> DataFrame:
    """Per device user: sum and count of each measure over the trips of the month.

    A device user's trips are the same for every policy the user drives
    under, so they are summed here once, before the cohort is joined, instead
    of once per policy and trip after it.
    """
    return month_trips.groupBy("sentiance_id").agg(
        F.count("*").alias("trip_count"),
        F.max(F.coalesce(F.col(LATE_DRIVE), F.lit(1))).alias("any_late_drive"),
        *[F.sum(c).alias(f"{c}_sum") for c in TRIP_MEASURES],
        *[F.count(c).alias(f"{c}_n") for c in TRIP_MEASURES],
    )


def month_and_history(trips: DataFrame, month: str) -> DataFrame:
    """Per device user, in one pass over the trips: the month's sums as ``driver_sums``
    gives them, null without a trip of the month, and whether the user drove in the
    previous month or before it, null without an earlier trip.

    Trips that start after the month are cut off in the scan where the times are
    stored as timestamps; text has to be read to be compared.
    """
    timed = trips.withColumn("_start", as_timestamp(trips, "start_ts")).withColumn(
        "_end", as_timestamp(trips, "end_ts")
    )
    start, own = F.col("_start"), in_month(F.col("_start"), month) & in_month(F.col("_end"), month)
    past, previous = start < month_start(month), start >= month_start(month, -1)
    mine = {c: F.when(F.col("_own"), F.col(c)) for c in TRIP_MEASURES}
    late = F.when(F.col("_own"), F.coalesce(F.col(LATE_DRIVE), F.lit(1)))
    found = (
        timed.filter(start < month_start(month, 1))
        .withColumn("_own", F.coalesce(own, F.lit(False)))
        .groupBy("sentiance_id")
        .agg(
            F.count_if("_own").alias("_trips"),
            F.max(late).alias("any_late_drive"),
            *[F.sum(m).alias(f"{c}_sum") for c, m in mine.items()],
            *[F.count(m).alias(f"{c}_n") for c, m in mine.items()],
            F.max(F.when(past, previous)).alias("drove_previous_month"),
            F.max(F.when(past, ~previous)).alias("drove_before"),
        )
    )
    drove = F.col("_trips") > 0
    counts = {f"{c}_n": F.when(drove, F.col(f"{c}_n")) for c in TRIP_MEASURES}
    return found.withColumns({"trip_count": F.when(drove, F.col("_trips"))} | counts).drop("_trips")


def own_mean(measure: str) -> Column:
    return F.try_divide(F.col(f"{measure}_sum"), F.col(f"{measure}_n"))


def mean_over_cohort(members: DataFrame) -> DataFrame:
    """One struct: mean of each measure over the trips of all cohort rows."""
    means = [
        F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n")).alias(c) for c in TRIP_MEASURES
    ]
    return members.agg(F.struct(*means))


def features_from_sums(members: DataFrame) -> DataFrame:
    """Monthly features of cohort rows that carry the sums of their user.

    The same values as filling each trip and rolling up: a driver's missing
    trips take the mean of the present ones, which leaves the mean alone and
    adds it once per missing trip to the sum. The global mean weighs each
    user's sums by the cohort rows that carry them. Rows without trips keep
    null features.
    """
    with_overall = members.withColumn("_overall", mean_over_cohort(members).scalar())

    def mean(c):
        return F.coalesce(own_mean(c), F.col("_overall")[c], F.lit(0.0))

    def total(c):
        missing = F.col("trip_count") - F.col(f"{c}_n")
        return F.coalesce(F.col(f"{c}_sum"), F.lit(0.0)) + missing * mean(c)

    had_trips = F.col("trip_count").isNotNull()
    features = {
        "avg_hard_accel": mean("hard_accel"),
        "avg_hard_brake": mean("hard_brake"),
        "avg_legal": mean("legal"),
        "avg_overall_score": mean("overall_score"),
        "total_distance": total("distance"),
        "total_trip_duration": total("trip_duration"),
        "total_late_drive_duration": total("late_drive_duration"),
    }
    filled = with_overall.withColumns(
        {name: F.when(had_trips, value) for name, value in features.items()}
    )
    scratch = [f"{c}_{s}" for c in TRIP_MEASURES for s in ("sum", "n")]
    rounded = with_late_ratio(filled)
    # least() skips nulls, so the ratio of a row without trips would read 1
    return rounded.withColumn(
        "late_drive_ratio", F.when(had_trips, F.col("late_drive_ratio"))
    ).drop(*scratch, "_overall")
