"""Scans, sinks and the policy-device mapping."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.sql import select, with_tables
from catalogue.testbed import Testbed, run_ts
from tarmac.operators.quality import duplicate_keys, row_count_change
from tarmac.plans.mapping import (
    build_policy_device_mapping,
    exposure_with_devices,
    first_detections,
    latest_devices,
    latest_exposure,
    mapping_with_metrics,
    renamed_exposure,
    with_corrected_installation,
    with_policy_features,
)
from tarmac.sources.session import fresh_path
from tarmac.sources.tables import (
    overwrite,
    overwrite_partitions,
    overwrite_table,
    scan_all,
    scan_table,
)

MI_COLUMNS = """source_data, policy_no, policy_number, t:policy_inception_date,
t:item_inception_date, t:cancelled_date, t:eff_from_date, t:eff_to_date, section_code,
cover_code, item_description, veh_make, veh_model, registration, vin_number, imei_number,
r:cover_premium, r:cover_sum_insured, cover_description, policy_status, cover_status,
lob_asset_id, item_no_raw, policy_cancellation_reason_code, t:end_date,
t:effective_from_date, t:effective_to_date, effective_year_month, effective_year,
effective_quarter, effective_month, effective_year_quarter, t:item_cancelled_date,
r:premium_collected, active_lob_asset_id"""

MAPPING_COLUMNS = """source_data, policy_version_number, policy_product_description,
policy_number, item_no, r:premium, r:premium_collected, r:cover_sum_insured,
active_lob_asset_id, original_lob_asset_id, vin_number, imei_number, make, model,
registration_number, section_code, cover_code, item_description, cover_description,
policy_status, cover_status, policy_cancellation_reason_code, t:item_inception_datetime,
t:policy_inception_date, t:item_cancellation_date, t:policy_cancellation_date,
t:imei_first_detection_datetime, t:installation_datetime, effective_year_month,
t:effective_from_date, t:effective_to_date, t:inserted_timestamp"""


def featured(tb: Testbed) -> DataFrame:
    return with_policy_features(renamed_exposure(tb.mi_exposure()))


def corrected_devices(tb: Testbed) -> DataFrame:
    return with_corrected_installation(
        latest_devices(tb.devices()), first_detections(tb.user_imei())
    )


def mapping(tb: Testbed) -> DataFrame:
    return build_policy_device_mapping(
        tb.devices(), tb.user_imei(), tb.mi_exposure(), run_ts(), tb.many_lines()
    )


@query("src_table_scan", select("o_orderkey, o_custkey, o_orderstatus, r:o_totalprice, t:o_orderdate, o_orderpriority", "orders"))
def src_table_scan(tb):
    tb.table("orders").createOrReplaceTempView("scanned_orders")
    return scan_table(tb.spark, "scanned_orders")


@query("src_sql_scan", select("p_partkey, p_name, p_brand, p_type, p_size, r:p_retailprice", "part"))
def src_sql_scan(tb):
    tb.table("part").createOrReplaceTempView("scanned_part")
    return scan_all(tb.spark, '"scanned_part"')


@query("sink_overwrite", select("policy_number, item_no, t:inserted_datetime, imei_number, t:installation_datetime, row_id", "devices"))
def sink_overwrite(tb):
    path = fresh_path(tb.spark, "overwrite")
    overwrite(tb.user_imei(), path)
    overwrite(tb.devices(), path)
    return tb.spark.read.parquet(path)


@query(
    "sink_catalog_table",
    select("policy_number, item_no, t:inserted_datetime, imei_number, t:installation_datetime, row_id", "devices"),
)
def sink_catalog_table(tb):
    """A catalog table replaced by one of another schema, in Spark's own catalog."""
    name = f"devices_{uuid.uuid4().hex}"
    path = fresh_path(tb.spark, "catalog")
    overwrite_table(tb.user_imei(), name, comment="device rows", path=path)
    overwrite_table(tb.devices(), name, comment="device rows", path=path)
    return scan_table(tb.spark, name)


@query(
    "sink_partition_overwrite",
    with_tables("""
select policy_number, item_no, imei_number, effective_year_month,
       round(cast(premium_collected as double)
             * case when effective_year_month = '202401' then 2 else 1 end + 1e-8, 6)
         as premium_collected
from mapping"""),
)
def sink_partition_overwrite(tb):
    path = fresh_path(tb.spark, "partitions")
    exposure = tb.exposure().select(
        "policy_number", "item_no", "imei_number", "effective_year_month",
        F.col("premium_collected").cast("double").alias("premium_collected"),
    )
    overwrite(exposure, path, ["effective_year_month"])
    corrected = exposure.filter(F.col("effective_year_month") == "202401").withColumn(
        "premium_collected", F.col("premium_collected") * 2
    )
    overwrite_partitions(corrected, path, ["effective_year_month"])
    stored = tb.spark.read.parquet(path)
    return stored.withColumn(
        "effective_year_month", F.col("effective_year_month").cast("string")
    )


@query("mi_rename", select(MI_COLUMNS, "mi"))
def mi_rename(tb):
    return renamed_exposure(tb.mi_exposure())


@query(
    "mi_policy_features",
    select("policy_no, cleaned_policy_no, policy_product_description, policy_version_number", "featured"),
)
def mi_policy_features(tb):
    return featured(tb).select(
        "policy_no", "cleaned_policy_no", "policy_product_description", "policy_version_number"
    )


@query(
    "mi_latest",
    select(
        "policy_number, lob_asset_id, effective_year_month, policy_version_number, "
        "r:cover_premium, r:premium_collected, item_no_raw, vin_number",
        "mi_latest",
    ),
)
def mi_latest(tb):
    return latest_exposure(featured(tb)).select(
        "policy_number", "lob_asset_id", "effective_year_month", "policy_version_number",
        "cover_premium", "premium_collected", "item_no_raw", "vin_number",
    )


@query(
    "telematics_latest",
    select("policy_number, item_no, t:inserted_datetime, imei_number, t:installation_datetime", "devices_latest"),
)
def telematics_latest(tb):
    return latest_devices(tb.devices())


@query("imei_first_seen", select("imei_number, t:imei_first_detection_datetime", "first_seen"))
def imei_first_seen(tb):
    return first_detections(tb.user_imei())


@query(
    "install_correction",
    select(
        "imei_number, policy_number, item_no, t:inserted_datetime, t:installation_datetime, "
        "t:imei_first_detection_datetime, t:installation_datetime_final",
        "corrected",
    ),
)
def install_correction(tb):
    return corrected_devices(tb)


@query(
    "mapping_join",
    select(
        "policy_number, item_no, effective_year_month, policy_version_number, "
        "t:imei_first_detection_datetime, t:installation_datetime",
        "mapping",
    ),
)
def mapping_join(tb):
    joined = exposure_with_devices(latest_exposure(featured(tb)), corrected_devices(tb))
    return joined.select(
        "policy_number", F.col("lob_asset_id").alias("item_no"), "effective_year_month",
        "policy_version_number", "imei_first_detection_datetime", "installation_datetime",
    )


@query("mapping_full", select(MAPPING_COLUMNS, "mapping"))
def mapping_full(tb):
    return mapping(tb)


@query(
    "mapping_metrics",
    with_tables("""
select 'devices' as table_name, (select count(*) from devices) as row_count
union all select 'user_imei', (select count(*) from user_imei)
union all select 'exposure', (select count(*) from mi)
union all select 'mapping', (select count(*) from mapping)"""),
)
def mapping_metrics(tb):
    written, counters = mapping_with_metrics(
        tb.devices(), tb.user_imei(), tb.mi_exposure(), run_ts(), tb.many_lines()
    )
    overwrite(written, fresh_path(tb.spark, "mapping"))
    rows = [(name, counter.get["row_count"]) for name, counter in counters.items()]
    return tb.spark.createDataFrame(rows, "table_name string, row_count long")


@query(
    "join_inflation",
    with_tables("""
select (select count(*) from mi_latest) as rows_before,
       (select count(*) from mapping) as rows_after,
       (select count(*) from mapping) - (select count(*) from mi_latest) as rows_added,
       (select count(*) from mapping) > (select count(*) from mi_latest) as inflated"""),
)
def join_inflation(tb):
    before = latest_exposure(featured(tb))
    return row_count_change(before, exposure_with_devices(before, corrected_devices(tb)))


@query(
    "duplicate_keys",
    with_tables("""
select policy_number, lob_asset_id, effective_year_month, count(*) as row_count
from mi group by all having count(*) > 1"""),
)
def duplicate_exposure_keys(tb):
    return duplicate_keys(
        renamed_exposure(tb.mi_exposure()),
        ["policy_number", "lob_asset_id", "effective_year_month"],
    )
