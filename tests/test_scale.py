"""Plans and balance: what the operators read, shuffle and put into one task."""

import contextlib
import io
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import QUERIES
from catalogue import testbed
from tarmac.operators.joins import left_join_many
from tarmac.operators.latest import keep_latest
from tarmac.operators.notrip import past_trip_flags
from tarmac.operators.quantiles import STEPS, exact_quantiles, melted, narrowed
from tarmac.operators.ranking import global_dense_rank, number_rows
from tarmac.operators.trips import driver_sums, month_and_history, trips_of_month
from tarmac.plans.cohort import from_month
from tarmac.schemas import TRIP_MEASURES
from tarmac.sources import session
from tarmac.sources.session import (
    IN_PLACE,
    PLACE,
    adaptive,
    fetch_by_place,
    freeze,
    freeze_placed,
    lean,
    scratch,
)
from tarmac.sources.tables import (
    insert_only_merge,
    overwrite,
    overwrite_partitions,
    rows_to_insert,
)


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def stored_trips(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trips") / "t")
    measures = [F.rand(3).alias(c) for c in TRIP_MEASURES]
    spark.range(3000).select(
        F.concat(F.lit("s"), (F.col("id") % 40).cast("string")).alias("sentiance_id"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id") * 3600).alias("start_ts"),
        F.timestamp_seconds(F.lit(1700001000) + F.col("id") * 3600).alias("end_ts"),
        *measures,
        F.lit(0).alias("late_drive"),
        F.lit("unused").alias("extra"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_month_filter_and_columns_reach_the_scan(stored_trips):
    text = plan(driver_sums(trips_of_month(stored_trips, "202401")))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(start_ts,2024-01-01" in pushed
    assert "LessThan(end_ts,2024-02-01" in pushed
    read = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "extra" not in read and "hard_accel" in read


def test_history_is_read_in_two_columns(stored_trips):
    text = plan(past_trip_flags(stored_trips, "202401"))
    read = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "hard_accel" not in read and "end_ts" not in read
    assert "LessThan(start_ts,2024-01-01" in text


def test_keep_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    text = plan(keep_latest(df, ["k"], ["id"]), "simple")
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_hot_join_keys_are_split(spark, tmp_path):
    """A key with most of the rows on both sides of the mapping join is split."""
    hot = F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.col("id").cast("string"))
    left_path, right_path = str(tmp_path / "l"), str(tmp_path / "r")
    spark.range(40_000).select(hot.alias("k"), "id").repartition(8).write.parquet(left_path)
    spark.range(50).select(
        F.when(F.col("id") < 5, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("rk"),
        F.col("id").alias("v"),
    ).write.parquet(right_path)
    adaptive(spark)
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
    ):
        left, right = spark.read.parquet(left_path), spark.read.parquet(right_path)
        joined = left_join_many(left, right, "k", "rk")
        rows = joined.count()
        text = plan(joined, "simple")
        joined.collect()
        text = plan(joined, "simple")
    expected = left.join(F.broadcast(right), left.k == right.rk, "left").count()
    assert rows == expected
    assert "skew=true" in text


def test_exact_quantiles_match_sorted_ranks(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(size=30_000)
    b = np.where(rng.uniform(size=30_000) < 0.4, 0.25, rng.uniform(size=30_000))  # a hot value
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a double, b double")
    got = {
        (r.component, r.share): r.quantile
        for r in exact_quantiles(melted(df, ["a", "b"]), (0.0, 0.2, 0.5, 0.8, 1.0)).collect()
    }
    for name, values in (("a", np.sort(a)), ("b", np.sort(b))):
        for share in (0.2, 0.5, 0.8, 1.0):
            assert got[name, share] == values[int(np.ceil(share * len(values))) - 1]
        assert got[name, 0.0] == values[0]


def test_quantiles_of_few_and_equal_values(spark):
    def quantile(values, share):
        df = spark.createDataFrame([(v,) for v in values], "a double")
        return [r.quantile for r in exact_quantiles(melted(df, ["a"]), (share,)).collect()]

    assert quantile([3.0, 1.0, 2.0, None], 0.5) == [2.0]
    assert quantile([7.0] * 9, 0.2) == [7.0]
    assert quantile([None], 0.5) == []


def test_numbers_run_through_and_follow_the_order(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    rows = number_rows(df, ["k"]).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(1, 5001))
    assert [r.k for r in rows] == sorted(r.k for r in rows)


def test_dense_rank_with_a_hot_key_and_nulls(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string"))
    df = spark.range(900).select(
        hot.alias("k"), F.when(F.col("id") % 5 != 0, F.lit(1.0)).alias("s")
    )
    got = sorted(global_dense_rank(df, ["k", "s"]).collect(), key=str)
    want = sorted(
        df.selectExpr("*", "dense_rank() over (order by k, s nulls last) as row_id").collect(), key=str
    )
    assert got == want


def test_frozen_tables_keep_types_and_cut_the_plan(spark):
    df = spark.range(10).selectExpr("id", "cast(id as decimal(18,2)) as m", "timestamp_ntz'2024-01-01' as t")
    stored = freeze(df.withColumn("x", F.col("id") * 2))
    assert stored.drop("x").schema.simpleString() == df.schema.simpleString()
    assert "Range" not in plan(stored, "simple")


def test_only_named_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "m string, v int")
    overwrite(df, path, ["m"])
    overwrite_partitions(spark.createDataFrame([("b", 9)], "m string, v int"), path, ["m"])
    assert sorted((r.m, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 9)]
    overwrite(df.filter("v = 1").withColumn("w", F.lit(0)), path, ["m"])
    stored = spark.read.parquet(path)
    assert stored.columns == ["v", "w", "m"] and stored.count() == 1


def registered(spark, name):
    return QUERIES[name](spark, "/root/testdata/sf0.001")


def test_mapping_reads_exposure_once(spark):
    text = plan(registered(spark, "mapping_full"), "simple")
    scans = [line for line in text.splitlines() if "FileScan" in line and "l_extendedprice" in line]
    assert len(scans) == 1


def test_large_mapping_moves_no_whole_rows(spark, monkeypatch):
    """Beyond MANY_LINES nothing is left to shuffle when the mapping is written."""
    want = sorted(map(str, registered(spark, "mapping_full").collect()))
    monkeypatch.setattr(testbed, "MANY_LINES", 1000)
    mapping = registered(spark, "mapping_full")
    assert "Exchange" not in plan(mapping, "simple")
    assert sorted(map(str, mapping.collect())) == want


def test_rows_are_fetched_by_place_where_they_are(spark):
    tables = len(spark.catalog.listTables())
    rows = spark.range(3000).withColumn("wide", F.md5(F.col("id").cast("string")))
    stored = freeze_placed(rows.repartition(5))
    chosen = freeze(stored.filter("id % 3 = 0").select(*PLACE, (F.col("id") + 1).alias("next")))
    with lean(spark, IN_PLACE), settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(stored.join(chosen.hint("shuffle_hash"), list(PLACE)), "simple")
    got = sorted((r.id, r.wide, r.next) for r in fetch_by_place(stored, chosen).collect())
    assert text.count("Exchange") == 1
    assert text.index("wide") < text.index("Exchange") and "wide" not in text[text.index("Exchange") :]
    assert got == sorted((r.id, r.wide, r.id + 1) for r in rows.collect() if r.id % 3 == 0)
    assert len(spark.catalog.listTables()) == tables


def test_shuffle_files_go_when_a_lean_copy_is_written(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in folders for f in Path(d).rglob("shuffle_*")}

    before = files()
    with lean(spark):
        freeze(spark.range(1000).repartition(4, "id"))
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    freeze(spark.range(1000).repartition(4, "id"))
    assert files() - before


@pytest.fixture(scope="module")
def stored_exposure(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("exposure") / "e")
    months = ["2023-12", "202312", "2024-01", "202401", "2024-02", "202402", "2024-10", "202410"]
    rows = [("p", str(n), m) for n, m in enumerate(months)]
    frame = spark.createDataFrame(rows, "policy_number string, item_no string, effective_year_month string")
    overwrite(frame, path, ["effective_year_month"])
    return spark.read.option("basePath", path).schema(frame.schema).parquet(path)


@pytest.mark.parametrize("month", ["202402", "2024-02"])
def test_months_prune_partitions_in_both_spellings(stored_exposure, month):
    chosen = from_month(stored_exposure, month)
    got = sorted(r.effective_year_month for r in chosen.collect())
    assert got == ["202402", "202402", "202410", "202410"]
    filters = next(line for line in plan(chosen).splitlines() if "PartitionFilters" in line)
    assert "effective_year_month" in filters and ">= 2024-02" in filters


def test_month_and_history_come_from_one_scan(stored_trips):
    found = month_and_history(stored_trips, "202401")
    text = plan(found)
    assert text.count("ReadSchema") == 1 and "LessThan(start_ts,2024-02-01" in text
    got = {r.sentiance_id: r.asDict() for r in found.collect()}
    sums = {r.sentiance_id: r.asDict() for r in driver_sums(trips_of_month(stored_trips, "202401")).collect()}
    flags = {r.sentiance_id: r.asDict() for r in past_trip_flags(stored_trips, "202401").collect()}
    assert set(got) == set(sums) | set(flags)
    for user, row in got.items():
        for name, value in {**sums.get(user, {}), **flags.get(user, {})}.items():
            assert row[name] == (pytest.approx(value) if isinstance(value, float) else value)
        if user not in sums:
            assert row["trip_count"] is None and row["legal_n"] is None


def test_brackets_of_many_distinct_values_stay_narrow(spark):
    values = spark.range(1_000_000).select(F.lit("a").alias("component"), F.rand(3).alias("value"))
    values = freeze(values)
    bands = values.groupBy("component").agg(F.count("*").alias("n")).select(
        "component", "n", F.lit(0.2).alias("share"), F.lit(0.1).alias("low"), F.lit(0.3).alias("high")
    )
    band = narrowed(values, bands).first()
    inside = values.filter((F.col("value") >= band.low) & (F.col("value") <= band.high)).count()
    assert inside < 5 * 200_000 / STEPS
    got = exact_quantiles(values, (0.2,)).first().quantile
    assert values.filter(F.col("value") <= got).count() == 200_000


def test_the_merge_reads_the_cycles_of_its_source_only(spark, tmp_path):
    path = str(tmp_path / "target")
    rows = [(k, cycle, "old") for cycle in range(60, 80) for k in range(5)]
    ddl = "k int, cycle_number int, v string"
    spark.createDataFrame(rows, ddl).write.partitionBy("cycle_number").parquet(path)
    source = spark.createDataFrame([(3, 79, "new"), (9, 79, "new")], ddl)
    target = spark.read.schema(source.schema).parquet(path)
    keys = ["k", "cycle_number"]
    wanted = rows_to_insert(target, source, keys, within="cycle_number")
    assert "PartitionFilters: [isnotnull(cycle_number" in plan(wanted).replace("\n", " ")
    insert_only_merge(source, path, keys, partition_by="cycle_number")
    stored = spark.read.schema(source.schema).parquet(path)
    assert stored.count() == 101 and stored.filter("v = 'new'").first().k == 9
    with pytest.raises(ValueError, match="none of the keys"):
        rows_to_insert(target, source, ["k"], within="cycle_number")


def test_rewards_write_three_copies_at_most(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    with scratch(spark):
        registered(spark, "rewards_full")
        assert len(list((tmp_path / "tarmac").iterdir())) <= 3
    assert not list((tmp_path / "tarmac").iterdir())


def test_own_copies_need_a_shared_folder():
    class Bare:
        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

        class sparkContext:  # noqa: N801
            getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Bare)


def test_no_task_makes_the_logs_of_more_customers_than_its_share(spark, tmp_path, monkeypatch):
    key = F.col("id")
    spark.range(0, 300, 1, 1).select(
        key.alias("c_custkey"), F.lit("name").alias("c_name"), F.lit(0).alias("c_nationkey"),
        F.lit(1.0).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"),
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1).select(
        key.cast("int").alias("n_nationkey"), F.lit("land").alias("n_name")
    ).write.parquet(f"{tmp_path}/nation.parquet")
    monkeypatch.setattr(testbed, "CUSTOMER_ROWS", 30)
    tb = testbed.Testbed(spark, str(tmp_path))
    log = tb.geocode_log().groupBy(F.spark_partition_id()).agg(F.count_distinct("id").alias("n"))
    assert log.agg(F.max("n")).first()[0] <= 2 * 30
    assert tb.geocode_log().select("id").distinct().count() == 300 - 6  # every fiftieth is empty


def test_the_left_side_of_a_join_is_shuffled_once(spark, tmp_path):
    left_path, right_path = str(tmp_path / "l"), str(tmp_path / "r")
    spark.range(2000).select((F.col("id") % 900).alias("k"), "id").write.parquet(left_path)
    many = F.when(F.col("id") < 100, F.lit(7)).otherwise(F.col("id"))
    spark.range(3000).select(many.alias("rk"), F.col("id").alias("v")).write.parquet(right_path)
    adaptive(spark)
    size = "20k"  # as in a large run, where neither side can be sent to every task
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold=size,
        spark__sql__adaptive__autoBroadcastJoinThreshold=size,
    ):
        left, right = spark.read.parquet(left_path), spark.read.parquet(right_path)
        joined = left_join_many(left, right, "k", "rk")
        text = plan(joined, "simple")
        got = sorted(joined.collect(), key=str)
    assert text.count("Exchange hashpartitioning") == 2  # either side once
    assert got == sorted(left.join(right, left.k == right.rk, "left").collect(), key=str)
