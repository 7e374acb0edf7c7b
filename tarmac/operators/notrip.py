"""Clients without a trip in the month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.dates import as_timestamp, month_start
from tarmac.functions.numbers import money_sum, percent_of
from tarmac.operators.joins import in_order
from tarmac.schemas import CLIENT_ORDER, DRIVER_KEYS

# Category labels and their percents.
NEVER, NEVER_PERCENT = "Absolutely No Trip Ever", 0.00
RECENT, RECENT_PERCENT = "Did Not Drive This Month (Device Working)", 0.40
STOPPED, STOPPED_PERCENT = "Had Trips Then Stopped", 0.05
HAD_TRIPS = "Had Trips"


def all_clients(cohort: DataFrame, with_scaling: DataFrame) -> DataFrame:
    """Every client of the cohort, with the month's results where there are any."""
    clients = cohort.select(*DRIVER_KEYS, "premium_collected").dropDuplicates()
    joined = clients.join(with_scaling.drop("premium_collected"), list(DRIVER_KEYS), "left")
    return in_order(joined, CLIENT_ORDER).withColumn(
        "no_trip_flag", F.when(F.col("trip_count").isNull(), 1).otherwise(0)
    )


def past_trip_flags(trips: DataFrame, month: str) -> DataFrame:
    """Per device user with past trips: any in the previous month, any before it.

    One pass over two columns of the trips answers all the membership
    questions; trips from the month on are cut off in the scan.
    """
    started = trips.select("sentiance_id", as_timestamp(trips, "start_ts").alias("start"))
    past = started.filter(F.col("start") < month_start(month))
    in_previous = F.col("start") >= month_start(month, -1)
    return past.groupBy("sentiance_id").agg(
        F.max(in_previous).alias("drove_previous_month"),
        F.max(~in_previous).alias("drove_before"),
    )


def category(previous: Column) -> Column:
    """Class of a client without trips; a null flag means no past trip at all."""
    return F.when(previous.isNull(), NEVER).when(previous, RECENT).otherwise(STOPPED)


def category_percent(reward_category: Column) -> Column:
    return (
        F.when(reward_category == NEVER, F.lit(NEVER_PERCENT))
        .when(reward_category == RECENT, F.lit(RECENT_PERCENT))
        .when(reward_category == STOPPED, F.lit(STOPPED_PERCENT))
    )


def no_trip_rewards(clients: DataFrame, trips: DataFrame, month: str) -> DataFrame:
    """Clients without trips, with their class, percent and amount."""
    without_trips = clients.filter(F.col("no_trip_flag") == 1)
    flagged = without_trips.join(past_trip_flags(trips, month), "sentiance_id", "left")
    return (
        flagged.withColumn("reward_category", category(F.col("drove_previous_month")))
        .withColumn("cashback_percent", category_percent(F.col("reward_category")))
        .withColumn("cashback_amount", F.col("premium_collected") * F.col("cashback_percent"))
        .select(*clients.columns, "reward_category")
    )


def no_trip_summary(no_trips: DataFrame) -> DataFrame:
    """Clients, premium and cashback per class."""
    return no_trips.groupBy("reward_category").agg(
        F.count("*").alias("client_count"),
        money_sum(F.col("premium_collected")).alias("total_premiums"),
        money_sum(F.col("cashback_amount")).alias("total_cashback_paid"),
        F.round(
            percent_of(
                money_sum(F.col("cashback_amount")), money_sum(F.col("premium_collected"))
            ),
            2,
        ).alias("cashback_percent_of_premium"),
    )


def month_totals(clients: DataFrame, no_trips: DataFrame) -> DataFrame:
    """One row: premium and payments of the month, clients with and without trips."""
    trip_sums = clients.filter(F.col("trip_count").isNotNull()).agg(
        F.struct(
            F.coalesce(money_sum(F.col("premium_collected")), F.lit(0)).alias("premium"),
            F.coalesce(money_sum(F.col("scaled_cashback_amount")), F.lit(0)).alias("paid"),
        )
    )
    sums = no_trips.agg(
        F.coalesce(money_sum(F.col("premium_collected")), F.lit(0)).alias("no_trip_premium"),
        F.coalesce(money_sum(F.col("cashback_amount")), F.lit(0)).alias("no_trip_paid"),
    ).withColumn("_trips", trip_sums.scalar())
    premium = F.col("_trips.premium") + F.col("no_trip_premium")
    paid = F.col("_trips.paid") + F.col("no_trip_paid")
    return sums.select(
        "no_trip_premium",
        "no_trip_paid",
        F.round(percent_of(F.col("no_trip_paid"), F.col("no_trip_premium")), 2).alias(
            "no_trip_pct"
        ),
        premium.alias("month_premium"),
        paid.alias("month_paid"),
        percent_of(paid, premium).alias("month_pct"),
    )


def union_results(clients: DataFrame, no_trips: DataFrame) -> DataFrame:
    """Clients with trips and clients without, in one table.

    The scaled amount of a client without trips is the plain amount; columns
    that only one side has are null on the other.
    """
    with_trips = clients.filter(F.col("trip_count").isNotNull()).withColumn(
        "reward_category", F.lit(HAD_TRIPS)
    )
    aligned = no_trips.withColumn(
        "scaled_cashback_amount", F.col("cashback_amount").cast("double")
    )
    stacked = with_trips.unionByName(aligned, allowMissingColumns=True)
    fields = [T.StructField(f.name, f.dataType) for f in with_trips.schema.fields]
    return stacked.to(T.StructType(fields))
