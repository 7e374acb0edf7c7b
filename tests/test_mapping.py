from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarmac.operators.joins import left_join_many
from tarmac.operators.latest import earliest_with_minimum, first_value, keep_earliest
from tarmac.operators.quality import assert_unique, duplicate_keys
from tarmac.plans.mapping import (
    build_policy_device_mapping,
    first_detections,
    latest_devices,
    latest_exposure,
    mapping_with_metrics,
    with_corrected_installation,
    with_policy_features,
)
from tarmac.schemas import EXPOSURE_RENAMES, MAPPING_COLUMNS
from tarmac.sources.tables import rename_known

EXPOSURE_DDL = """SourceData string, PolicyNo string, PolicyNumber string,
PolicyInceptionDate timestamp, ItemInceptionDate timestamp, CancelledDate timestamp,
EFF_FROM_DATE timestamp, EFF_TO_DATE timestamp, SectionCode string, CoverCode string,
ItemDescription string, VehMake string, VehModel string, Registration string,
VinNumber string, IMEINumber string, CoverPremium double, CoverSumInsured double,
CoverDescription string, PolicyStatus string, CoverStatus string, LOB_ASSET_ID string,
ItemNo string, PolicyCancellationReasonCode string, enddate timestamp,
effectivefromdate timestamp, effectivetodate timestamp, EffectiveYearMonth string,
EffectiveYear int, EffectiveQuarter int, EffectiveMonth int, EffectiveYearQuarter string,
ItemCancelledDate timestamp, PremiumPaid double, ACTIVE_LOB_ASSET_ID string"""
DEVICE_DDL = """policy_number string, item_no string, inserted_datetime timestamp,
imei_number string, installation_datetime timestamp"""
USER_DDL = "imei_number string, retrieved_datetime timestamp"


def run_time():
    return F.lit("2026-04-02 06:00:00").cast("timestamp")


def exposure_row(spark, **values):
    """One raw exposure row; columns that are not named are null."""
    given = {
        "SourceData": "legacy", "PolicyNo": "TRK-0-44/7", "PolicyNumber": "0440", "LOB_ASSET_ID": "0440-trailer",
        "ItemNo": "T9", "CoverPremium": 61.25, "EffectiveYearMonth": "2031-11", "PolicyStatus": "Lapsed",
    } | values
    schema = spark.createDataFrame([], EXPOSURE_DDL).schema
    return spark.createDataFrame([tuple(given.get(c) for c in schema.names)], schema)


def test_product_and_version_from_policy_number(spark):
    numbers = ["MOT-77/3", "HOME/12", "12-A/4", "MOT-5", "MOT-5/x", None]
    df = spark.createDataFrame([(n,) for n in numbers], "policy_no string")
    got = {
        r.policy_no: (r.policy_product_description, r.policy_version_number)
        for r in with_policy_features(df).collect()
    }
    assert got == {
        "MOT-77/3": ("MOT", 3),
        "HOME/12": ("HOME", 12),
        "12-A/4": ("", 4),
        "MOT-5": ("MOT", None),
        "MOT-5/x": ("MOT", None),
        None: (None, None),
    }


def test_rename_skips_absent_columns(spark):
    df = spark.createDataFrame([(1, 2)], "PolicyNo int, other int")
    assert rename_known(df, EXPOSURE_RENAMES).columns == ["policy_no", "other"]


def test_highest_version_wins_and_missing_version_loses(spark):
    rows = [
        ("P", "a", "2026-03", 1), ("P", "a", "2026-03", 4), ("P", "a", "2026-03", None),
        ("P", "b", "2026-03", None), ("Q", "a", "2026-03", 2), ("P", "a", "2026-04", 0),
    ]
    ddl = "policy_number string, lob_asset_id string, effective_year_month string, policy_version_number int"
    got = {tuple(r) for r in latest_exposure(spark.createDataFrame(rows, ddl)).collect()}
    assert got == {
        ("P", "a", "2026-03", 4), ("P", "b", "2026-03", None),
        ("Q", "a", "2026-03", 2), ("P", "a", "2026-04", 0),
    }


def test_last_inserted_device_row_without_helper_column(spark):
    inserted = {"kept": datetime(2019, 7, 9, 13), "same day": datetime(2019, 7, 9, 8), "first": datetime(2017, 2, 28)}
    rows = [("0440", "t", at, name, None, n) for n, (name, at) in enumerate(inserted.items())]
    rows += [("0440", "u", datetime(2011, 1, 1), "other item", None, 9)]
    devices = latest_devices(spark.createDataFrame(rows, DEVICE_DDL + ", row_id int"))
    assert "row_id" not in devices.columns
    assert {r.imei_number for r in devices.collect()} == {"kept", "other item"}


def test_installation_is_the_earliest_signal(spark):
    """Seen before, after and without an install time; never seen; neither."""
    morning, noon, night = (datetime(2018, 9, 30, h) for h in (6, 12, 23))
    cases = {
        "seen before": (noon, [night, morning], morning),
        "seen after": (morning, [noon, night], morning),
        "same time": (noon, [noon], noon),
        "no install time": (None, [night, noon], noon),
        "never seen": (night, [], night),
        "neither": (None, [], None),
    }
    devices = [("0440", "t", None, name, installed) for name, (installed, _, _) in cases.items()]
    seen = [(name, at) for name, (_, times, _) in cases.items() for at in times]
    corrected = with_corrected_installation(
        spark.createDataFrame(devices, DEVICE_DDL),
        first_detections(spark.createDataFrame([*seen, ("unknown", morning)], USER_DDL)),
    )
    got = {r.imei_number: r.installation_datetime_final for r in corrected.collect()}
    assert got == {name: earliest for name, (_, _, earliest) in cases.items()}


def test_mapping_contract_and_matched_rows(spark):
    devices = spark.createDataFrame(
        [
            ("0440", "0440-trailer", datetime(2031, 11, 3), "beacon", datetime(2031, 11, 20)),
            ("0999", "0440-trailer", datetime(2031, 10, 2), "spare", None),
            ("0440", "0440-truck", datetime(2031, 11, 3), "cab", None),
        ],
        DEVICE_DDL,
    )
    users = spark.createDataFrame([("beacon", datetime(2031, 11, 18)), ("cab", datetime(2030, 1, 1))], USER_DDL)
    result = build_policy_device_mapping(devices, users, exposure_row(spark), run_time())
    assert tuple(result.columns) == MAPPING_COLUMNS
    assert len(set(MAPPING_COLUMNS)) == 32
    rows = result.collect()
    assert sorted(map(str, {r.installation_datetime for r in rows})) == ["2031-11-18 00:00:00", "None"]
    for r in rows:  # a device of another policy on the same item counts too
        assert (r.policy_version_number, r.policy_product_description) == (7, "TRK")
        assert (r.item_no, r.original_lob_asset_id, r.premium) == ("0440-trailer", "T9", 61.25)
        assert r.inserted_timestamp == datetime(2026, 4, 2, 6)
    assert len(rows) == 2


def test_exposure_without_device_is_kept(spark):
    elsewhere = spark.createDataFrame([("0440", "0440-boat", None, "beacon", None)], DEVICE_DDL)
    users = spark.createDataFrame([("beacon", datetime(2031, 11, 18))], USER_DDL)
    for asset in ("0440-trailer", None):
        exposure = exposure_row(spark, LOB_ASSET_ID=asset)
        [row] = build_policy_device_mapping(elsewhere, users, exposure, run_time()).collect()
        assert (row.policy_number, row.item_no) == ("0440", asset)
        assert row.installation_datetime is None and row.imei_first_detection_datetime is None


def odd_mapping_input(spark):
    """Devices, users and exposure with missing keys, equal versions, equal rows and a hot item."""
    def some(text, kinds, missing=11):
        drawn = F.pmod(F.xxhash64("id", F.lit(text)), F.lit(kinds)).cast("string")
        return F.when(F.col("id") % missing != 0, F.concat(F.lit(text), drawn))

    schema = spark.createDataFrame([], EXPOSURE_DDL).schema
    item = F.when(F.col("id") % 3 == 0, "hot").otherwise(some("item", 20, 7))
    known = {
        "PolicyNo": F.concat(some("MOT-", 9), F.lit("/"), (F.col("id") % 4).cast("string")),
        "PolicyNumber": some("p", 9, 13),
        "LOB_ASSET_ID": item,
        "EffectiveYearMonth": some("20240", 2),
        "CoverPremium": (F.col("id") % 5).cast("double"),
        "ItemNo": some("raw", 40),
        "ItemDescription": some("raw", 40),
    }
    rows = spark.range(600).select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )
    day = F.timestamp_seconds(F.lit(1700000000) + F.col("id") * 3600)
    devices = spark.range(300).select(
        some("p", 60, 13).alias("policy_number"), item.alias("item_no"), day.alias("inserted_datetime"),
        some("imei", 30).alias("imei_number"), F.when(F.col("id") % 5 > 0, day).alias("installation_datetime"),
    )
    users = spark.range(40).select(some("imei", 30).alias("imei_number"), day.alias("retrieved_datetime"))
    return devices, users, rows.union(rows.limit(50)).repartition(6)


def test_mapping_by_place_gives_the_same_rows(spark):
    tables = odd_mapping_input(spark)
    want = build_policy_device_mapping(*tables, run_time())
    got = build_policy_device_mapping(*tables, run_time(), by_place=True)
    assert got.schema.simpleString() == want.schema.simpleString()
    want, got = (sorted(map(str, df.collect())) for df in (want, got))
    assert got == want
    assert sum("item_no='hot'" in row for row in got) > 33 and len(got) > 600


def test_counters_fill_by_place(spark, tmp_path):
    devices, users, exposure = odd_mapping_input(spark)
    written, counters = mapping_with_metrics(devices, users, exposure, run_time(), by_place=True)
    written.write.parquet(str(tmp_path / "m"))
    rows = spark.read.parquet(str(tmp_path / "m")).count()
    assert {name: counter.get["row_count"] for name, counter in counters.items()} == {
        "devices": 300, "user_imei": 40, "exposure": 650, "mapping": rows,
    }


def test_left_join_many_equals_left_join(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate("aaabbcd")] + [(None, 9)], "k string, i int")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("e", 4), (None, 5)], "rk string, v int")
    got = sorted(left_join_many(left, right, "k", "rk").collect(), key=str)
    want = sorted(left.join(right, left.k == right.rk, "left").collect(), key=str)
    assert got == want


def test_earliest_row_takes_the_least_cancellation(spark):
    rows = [("k", 2, "late", None), ("k", 1, "early", 30), ("k", 3, "last", 20), ("m", 1, "x", None)]
    df = spark.createDataFrame(rows, "key string, month int, note string, cancelled int")
    got = {tuple(r) for r in earliest_with_minimum(df, ["key"], ["month"], "cancelled").collect()}
    assert got == {("k", 1, "early", 20), ("m", 1, "x", None)}


def test_first_present_value_per_key(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 2, 7), ("k", 3, 5), ("m", 1, None)], "key string, o int, v int")
    got = {tuple(r) for r in first_value(df, ["key"], "v", ["o"]).collect()}
    assert got == {("k", 7), ("m", None)}


def test_duplicate_keys_and_uniqueness(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    with pytest.raises(ValueError, match="duplicate"):
        assert_unique(df, ["k"])
    assert assert_unique(keep_earliest(df, ["k"], ["v"]), ["k"]).count() == 2
