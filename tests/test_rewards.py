import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarmac.functions.dates import cycle_end, cycle_maturation, cycle_number, cycle_start
from tarmac.functions.numbers import payout, share_of, stable_key, unit_hash
from tarmac.functions.policy import year_month
from tarmac.operators.cashback import (
    cashback_ladder,
    cashback_totals,
    earning_borderline,
    scaling_factor,
    with_scaling,
)
from tarmac.operators.clusters import fixed_centers, nearest_center, score_groups, with_group_values
from tarmac.operators.notrip import no_trip_rewards, past_trip_flags, union_results
from tarmac.operators.payout import (
    above_premium_floor,
    payout_buckets,
    up_to_premium_floor,
    with_charged_premium,
    zero_reasons,
)
from tarmac.operators.quality import not_covered, null_counts, row_count_change
from tarmac.operators.scoring import driving_score, score_summary, separation_weights
from tarmac.operators.trips import (
    cohort_trips,
    driver_sums,
    features_from_sums,
    fill_gaps,
    trips_of_month,
)
from tarmac.plans.cohort import active_cover, from_month, latest_exposure_rows
from tarmac.schemas import DRIVER_KEYS, REWARDS_SCHEMA, SCORE_COMPONENTS, TRIP_MEASURES
from tarmac.sources.tables import empty_table, insert_only_merge, rows_to_insert

TRIP_DDL = "sentiance_id string, start_ts string, end_ts string, " + ", ".join(
    f"{c} double" for c in TRIP_MEASURES
) + ", late_drive int"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def trip(user, start, end, measure=0.5, late=0, gaps=()):
    values = [None if c in gaps else measure for c in TRIP_MEASURES]
    return (user, start, end, *values, late)


def test_cycle_of_a_month(spark):
    assert value(spark, cycle_start("202510")) == dt.date(2025, 10, 1)
    assert value(spark, cycle_end("202510")) == dt.date(2025, 10, 28)
    assert value(spark, cycle_maturation("202511")) == dt.date(2026, 2, 28)
    assert value(spark, cycle_number(F.lit(dt.date(2025, 8, 28)))) == 80
    assert value(spark, cycle_number(F.lit(dt.date(2024, 1, 28)))) == 61
    assert value(spark, year_month(F.lit("2025-10"))) == "202510"


@pytest.mark.parametrize(
    "amount, paid",
    [(None, None), (-4.0, 0), (0.0, 0), (9.4, 0), (9.5, 20), (19.4, 20), (19.5, 20), (20.4, 20), (35.5, 36)],
)
def test_payout_thresholds(spark, amount, paid):
    assert value(spark, payout(F.lit(amount).cast("double"))) == paid


def test_ratio_is_guarded_and_clamped(spark):
    def ratio(a, b):
        return value(spark, share_of(F.lit(a), F.lit(b)))

    assert ratio(5.0, 2.0) == 1.0 and ratio(-1.0, 2.0) == 0.0 and ratio(0.0, 0.0) == 0.0
    assert ratio(1.0, 4.0) == pytest.approx(0.25)


def test_stable_key_keeps_empty_parts_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    keys = [r.k for r in df.select(stable_key(["x", "y", "z"]).alias("k")).collect()]
    assert keys == ["a||||b", "a||b||"]
    hashed = spark.range(2000).select(unit_hash(F.col("id").cast("string")).alias("u")).collect()
    assert all(0 <= r.u <= 1 for r in hashed) and 300 < sum(r.u < 0.2 for r in hashed) < 500


def test_months_compare_in_either_spelling(spark):
    df = spark.createDataFrame([("2025-09",), ("2025-10",), ("202511",)], "effective_year_month string")
    got = [r.effective_year_month for r in from_month(df, "202510").collect()]
    assert got == ["202510", "202511"]


def test_latest_month_wins_within_one_load(spark):
    rows = [("P", "a", 1, "202510", "x"), ("P", "a", 1, "202511", "y"), ("P", "a", 0, "202512", "z")]
    ddl = "policy_number string, item_no string, inserted_timestamp int, effective_year_month string, note string"
    [row] = latest_exposure_rows(spark.createDataFrame(rows, ddl)).collect()
    assert row.note == "y"


def test_active_cover(spark):
    cancelled = dt.datetime
    rows = [
        ("kept", " Policy ", "Policy", None),
        ("kept on the day", "Policy", "Policy", cancelled(2024, 4, 30)),
        ("cancelled", "Policy", "Policy", cancelled(2024, 4, 29)),
        ("lapsed cover", "Policy", "Cancelled", None),
        ("lapsed policy", "Ended", "Policy", cancelled(2024, 6, 1)),
        ("unknown", None, "Policy", None),
    ]
    ddl = "k string, policy_status string, cover_status string, item_cancellation_date timestamp"
    kept = {r.k for r in active_cover(spark.createDataFrame(rows, ddl), "202401").collect()}
    assert kept == {"kept", "kept on the day"}


def test_trips_start_and_end_in_the_month(spark):
    rows = [
        trip("inside", "2024-01-01 00:00:00", "2024-01-31 23:59:59"),
        trip("early", "2023-12-31 23:59:59", "2024-01-01 00:10:00"),
        trip("late", "2024-01-31 23:50:00", "2024-02-01 00:00:00"),
        trip("unreadable", "soon", "2024-01-02 00:00:00"),
    ]
    got = [r.sentiance_id for r in trips_of_month(spark.createDataFrame(rows, TRIP_DDL), "202401").collect()]
    assert got == ["inside"]


@pytest.fixture(scope="module")
def gaps(spark):
    """Two cohort rows share user s1; s2 misses every value of a measure."""
    cohort = spark.createDataFrame(
        [("s1", "P", "a", "d1"), ("s1", "Q", "b", "d1"), ("s2", "R", "c", "d2"), ("s3", "S", "d", "d3")],
        ", ".join(f"{k} string" for k in DRIVER_KEYS),
    )
    day = "2024-01-05 10:00:00"
    trips = spark.createDataFrame(
        [
            trip("s1", day, day, 0.2),
            trip("s1", day, day, 0.6, late=None, gaps=("legal", "distance")),
            trip("s2", day, day, 0.8, gaps=("legal", "hard_accel")),
            trip("s9", day, day, 0.9),
        ],
        TRIP_DDL,
    )
    return cohort, trips


def test_gaps_take_driver_then_global_mean(gaps):
    cohort, trips = gaps
    rows = fill_gaps(cohort, trips).collect()
    assert len(rows) == 5
    s1 = [r for r in rows if r.sentiance_id == "s1" and r.policy_number == "P"]
    assert sorted(r.legal for r in s1) == [0.2, 0.2]
    assert sorted(r.late_drive for r in s1) == [0, 1]
    [s2] = [r for r in rows if r.sentiance_id == "s2"]
    assert s2.legal == pytest.approx(0.2)  # two cohort rows carry 0.2
    assert s2.hard_accel == pytest.approx((0.2 + 0.6) * 2 / 4)
    assert s2.distance == 0.8


def test_sums_before_the_join_give_the_same_features(gaps):
    cohort, trips = gaps
    filled = fill_gaps(cohort, trips)
    averages = [F.avg(c).alias(f"avg_{c}") for c in ("hard_accel", "hard_brake", "legal", "overall_score")]
    totals = [F.sum(c).alias(f"total_{c}") for c in ("distance", "trip_duration", "late_drive_duration")]
    rest = [F.max("late_drive").alias("any_late_drive"), F.count("*").alias("trip_count")]
    grouped = filled.groupBy("policy_number").agg(*averages, *totals, *rest)
    literal = {r.policy_number: r.asDict() for r in grouped.collect()}
    members = cohort.join(driver_sums(trips), "sentiance_id", "left")
    fast = {r.policy_number: r.asDict() for r in features_from_sums(members).collect()}
    assert set(fast) == set(literal) | {"S"}
    assert fast["S"]["trip_count"] is None and fast["S"]["late_drive_ratio"] is None
    for policy, row in literal.items():
        for name, expected in row.items():
            assert fast[policy][name] == (
                pytest.approx(expected, abs=1e-9) if isinstance(expected, float) else expected
            ), name


def test_null_counts_only_list_drivers_with_gaps(gaps):
    cohort, trips = gaps
    rows = null_counts(cohort_trips(cohort, trips), DRIVER_KEYS, ["legal", "late_drive"]).collect()
    got = {(r.policy_number, r.legal_nulls, r.late_drive_nulls, r.total_nulls) for r in rows}
    assert got == {("P", 1, 1, 2), ("Q", 1, 1, 2), ("R", 1, 0, 1)}


FEATURE_DDL = ", ".join(f"{c} double" for c in SCORE_COMPONENTS)


def test_weights_follow_the_separation(spark):
    rows = [(i / 10, 0.5, 1 - i / 10, 0.5, 0.5) for i in range(11)]
    [w] = separation_weights(spark.createDataFrame(rows, FEATURE_DDL)).collect()
    assert w.avg_hard_accel == pytest.approx(0.5) and w.avg_legal == pytest.approx(0.5)
    assert w.avg_hard_brake == 0 and sum(w) == pytest.approx(1.0)


def test_equal_weights_without_rows_or_separation(spark):
    for rows in ([], [(0.5,) * 5] * 3, [(None, 0.1, 0.2, 0.3, 0.4)]):
        [w] = separation_weights(spark.createDataFrame(rows, FEATURE_DDL)).collect()
        assert list(w) == [pytest.approx(0.2)] * 5


def test_score_turns_bad_components_around(spark):
    features = spark.createDataFrame([(0.1, 0.2, 0.9, 0.8, 0.3), (None, 0.2, 0.9, 0.8, 0.3)], FEATURE_DDL)
    weights = spark.createDataFrame([(0.1, 0.2, 0.3, 0.15, 0.25)], FEATURE_DDL)
    scores = [r.driving_score for r in driving_score(features, weights).collect()]
    expected = 0.1 * 0.9 + 0.2 * 0.8 + 0.3 * 0.9 + 0.15 * 0.8 + 0.25 * 0.7
    assert sorted(scores, key=str) == [pytest.approx(expected), None]


def test_summary_of_scores(spark):
    df = spark.createDataFrame([(s,) for s in (0.1, 0.4, 0.4, 0.9, 0.9, None)], "driving_score double")
    [row] = score_summary(df).collect()
    assert (row.min_score, row.median_score, row.max_score) == (0.1, 0.4, 0.9)
    assert row.mode_score == 0.4 and row.mean_score == pytest.approx(0.54)


def scored(spark, *scores):
    return spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "id int, driving_score double")


def test_nearest_center_prefers_the_smaller_on_ties(spark):
    df = scored(spark, 0.0, 0.5, 0.76, None)
    near = nearest_center(df, fixed_centers(df, "202401", 0.1, [0.75, 0.25]))
    got = {r.id: (r.nearest_ms_center, r.nearest_ms_cluster) for r in near.collect()}
    assert got == {0: (0.25, 0), 1: (0.25, 0), 2: (0.75, 1), 3: (None, None)}
    [tie] = near.filter("id = 1").collect()
    assert tie.ms_center_gap == 0.25 and tie.bandwidth == 0.1


def test_group_values_beside_every_row(spark):
    df = scored(spark, 0.2, 0.3, 0.8, None)
    near = nearest_center(df, fixed_centers(df, "202401", 0.1, [0.25, 0.75]))
    rows = {r.id: r for r in with_group_values(near, score_groups(near)).collect()}
    assert (rows[0].min_ms_center, rows[0].max_ms_center, rows[0].no_drivers_per_group) == (0.2, 0.3, 2)
    assert (rows[3].min_ms_center, rows[3].no_drivers_per_group) == (None, 1)


def ladder(spark, *minima):
    rows = [(i, m, m - 0.01, m + 0.02, 3) for i, m in enumerate(minima)]
    ddl = """nearest_ms_cluster int, nearest_ms_center double, min_ms_center double,
             max_ms_center double, no_drivers_per_group long"""
    return cashback_ladder(spark.createDataFrame(rows, ddl))


@pytest.mark.parametrize(
    "centers, percents, borderline",
    [
        ((0.3, 0.4), [0, 0], 0.42),
        ((0.3, 0.6), [0, 0.3], 0.32),
        ((0.52, 0.6), [0.05, 0.3], 0.5),
        ((0.2, 0.55, 0.65, 0.75, 0.85), [0, 0.05, 0.05 + 0.25 / 3, 0.05 + 0.5 / 3, 0.3], 0.22),
        ((0.51,), [0.3], 0.5),
    ],
)
def test_cashback_ladder(spark, centers, percents, borderline):
    rungs = ladder(spark, *centers)
    got = [r.cashback_percent for r in rungs.orderBy("min_ms_center").collect()]
    assert got == [pytest.approx(p) for p in percents]
    assert earning_borderline(rungs).first()[0] == pytest.approx(borderline)
    assert rungs.filter("nearest_ms_cluster = 0").first().center_key == f"{centers[0]:.6f}"


def amounts(spark, *rows):
    return spark.createDataFrame(
        [(Decimal(p) if p is not None else None, c, n) for p, c, n in rows],
        "premium_collected decimal(18,2), cashback_amount double, trip_count long",
    )


@pytest.mark.parametrize(
    "rows, factor",
    [
        ([("100", 5.5, 1)], 1.0),
        ([("100", 5.0, 1)], 1.0),
        ([("100", 20.0, 1)], 0.25),
        ([("100", 2.0, 1)], 2.5),
        ([("100", 20.0, 1), ("900", 900.0, None)], 0.25),
        ([("100", 0.0, 1)], 0.0),
        ([("0", 5.0, 1)], 0.0),
        ([("100", -1.0, 1)], 0.0),
        ([(None, None, 1)], 0.0),
        ([], 0.0),
    ],
)
def test_scaling_factor(spark, rows, factor):
    df = amounts(spark, *rows)
    assert scaling_factor(df).first().scaling_factor == pytest.approx(factor)
    scaled = with_scaling(df, scaling_factor(df))
    assert scaled.count() == sum(n is not None for _, _, n in rows)
    totals = cashback_totals(scaled).first()
    if factor and len(rows) == 1:
        assert totals.scaled_cashback_pct == pytest.approx(factor * float(rows[0][1]))


def test_classes_of_clients_without_trips(spark):
    day = "{} 10:00:00"
    trips = spark.createDataFrame(
        [
            trip("previous", day.format("2023-12-31"), day.format("2023-12-31")),
            trip("previous", day.format("2023-05-01"), day.format("2023-05-01")),
            trip("stopped", day.format("2023-11-30"), day.format("2023-11-30")),
            trip("later", day.format("2024-02-01"), day.format("2024-02-01")),
        ],
        TRIP_DDL,
    )
    flags = {r.sentiance_id: tuple(r)[1:] for r in past_trip_flags(trips, "202401").collect()}
    assert flags == {"previous": (True, True), "stopped": (False, True)}
    clients = spark.createDataFrame(
        [(s, Decimal(100), None, None, None, None, 1) for s in ("previous", "stopped", "later", "none")]
        + [("driver", Decimal(100), 4, 0.3, 30.0, 9.0, 0)],
        """sentiance_id string, premium_collected decimal(18,2), trip_count long,
           cashback_percent double, cashback_amount double, scaled_cashback_amount double,
           no_trip_flag int""",
    )
    rewards = no_trip_rewards(clients, trips, "202401")
    got = {r.sentiance_id: (r.reward_category, r.cashback_amount) for r in rewards.collect()}
    assert got == {
        "previous": ("Did Not Drive This Month (Device Working)", 40.0),
        "stopped": ("Had Trips Then Stopped", 5.0),
        "later": ("Absolutely No Trip Ever", 0.0),
        "none": ("Absolutely No Trip Ever", 0.0),
    }
    everyone = {r.sentiance_id: r for r in union_results(clients, rewards).collect()}
    assert len(everyone) == 5 and everyone["driver"].reward_category == "Had Trips"
    assert everyone["driver"].scaled_cashback_amount == 9.0
    assert everyone["previous"].scaled_cashback_amount == 40.0
    assert not_covered(clients, rewards, "sentiance_id").collect() == [("driver",)]


def test_charged_premium_adds_no_rows(spark):
    results = spark.createDataFrame([("P", "a", "d", 12.345)], "policy_number string, item_no string, imei_number string, premium_collected double")
    exposure = spark.createDataFrame(
        [("P", "a", "d", 100.0, "old", "r1", 1), ("P", "a", "d", 120.0, "new", "r2", 2)],
        """policy_number string, item_no string, imei_number string, premium double,
           item_description string, original_lob_asset_id string, month int""",
    )
    enriched = with_charged_premium(results, exposure, ["month"])
    [row] = enriched.collect()
    assert (row.premium_charged, row.item_description, row.premium_collected) == (120.0, "new", 12.35)
    assert row_count_change(results, enriched).first().inflated is False
    assert row_count_change(results, results.union(results)).first().rows_added == 1


def test_buckets_and_reasons(spark):
    paid = spark.createDataFrame(
        [(20.0, 50.0), (30.0, 0.0), (0.0, 40.0), (0.0, 0.0), (0.0, None), (None, 10.0)],
        "cycle_reward_thresh double, premium_collected double",
    )
    buckets = {r.payout_bucket: r.num_clients for r in payout_buckets(paid).collect()}
    assert buckets == {"Earn > 0": 2, "Zero — no premium_collected": 2, "Zero — model 0%": 2}
    reasons = {r.reason: r.num_clients for r in zero_reasons(paid).collect()}
    assert reasons == {"Zero due to no premium_collected": 2, "Zero due to model 0%": 1}


def test_premium_floor_leaves_out_unknown_premiums(spark):
    df = spark.createDataFrame(
        [(Decimal(p) if p else None,) for p in ("1.84", "1.85", "-5", None)],
        "premium_collected decimal(18,2)",
    )
    assert [str(r[0]) for r in above_premium_floor(df).collect()] == ["1.85"]
    assert sorted(str(r[0]) for r in up_to_premium_floor(df).collect()) == ["-5.00", "1.84"]


def test_merge_inserts_each_missing_key_once(spark, tmp_path):
    path = str(tmp_path / "target")
    ddl = "policy_number string, cycle_number int, amount double"
    spark.createDataFrame([("P", 1, 5.0)], ddl).write.parquet(path)
    source = spark.createDataFrame([("P", 1, 9.0), ("P", 2, 7.0), ("Q", 1, 3.0), ("Q", 1, 2.0)], ddl)
    keys = ["policy_number", "cycle_number"]
    insert_only_merge(source, path, keys)
    stored = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert stored == [("P", 1, 5.0), ("P", 2, 7.0), ("Q", 1, 2.0)]
    assert rows_to_insert(spark.read.parquet(path), source, keys).count() == 0


def test_rewards_table_schema(spark):
    assert len(REWARDS_SCHEMA) == 39
    assert empty_table(spark, REWARDS_SCHEMA).count() == 0
