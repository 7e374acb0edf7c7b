"""Insured vehicles mapped to tracking devices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.policy import product_code, version_number, without_dashes
from tarmac.operators.joins import left_join_many
from tarmac.operators.latest import keep_latest
from tarmac.operators.quality import counted
from tarmac.schemas import EXPOSURE_RENAMES, MAPPING_COLUMNS
from tarmac.sources.session import PLACE, fetch_by_place, freeze_placed, lean
from tarmac.sources.tables import rename_known

EXPOSURE_KEYS = ("policy_number", "lob_asset_id", "effective_year_month")
EXPOSURE_TIE_BREAKS = (
    "cover_premium",
    "premium_collected",
    "cover_sum_insured",
    "item_cancelled_date",
    "policy_status",
    "cover_status",
    "item_inception_date",
    "policy_inception_date",
    "item_no_raw",
    "vin_number",
)
DEVICE_TIE_BREAKS = ("row_id", "installation_datetime", "imei_number")

# Output columns that are exposure columns under another name.
RENAMED_IN_OUTPUT = {
    "item_no": "lob_asset_id",
    "premium": "cover_premium",
    "original_lob_asset_id": "item_no_raw",
    "make": "veh_make",
    "model": "veh_model",
    "registration_number": "registration",
    "item_inception_datetime": "item_inception_date",
    "item_cancellation_date": "item_cancelled_date",
    "policy_cancellation_date": "cancelled_date",
}
FROM_DEVICES = ("imei_first_detection_datetime", "installation_datetime")


def renamed_exposure(raw: DataFrame) -> DataFrame:
    return rename_known(raw, EXPOSURE_RENAMES)


def with_policy_features(exposure: DataFrame) -> DataFrame:
    policy_no = F.col("policy_no")
    return exposure.withColumns(
        {
            "cleaned_policy_no": without_dashes(policy_no),
            "policy_product_description": product_code(policy_no),
            "policy_version_number": version_number(policy_no),
        }
    )


def latest_exposure(exposure: DataFrame) -> DataFrame:
    """Highest policy version per policy, asset and month."""
    return keep_latest(exposure, EXPOSURE_KEYS, ["policy_version_number"], EXPOSURE_TIE_BREAKS)


def latest_devices(devices: DataFrame) -> DataFrame:
    """Last inserted device row per policy and item."""
    latest = keep_latest(
        devices, ["policy_number", "item_no"], ["inserted_datetime"], DEVICE_TIE_BREAKS
    )
    return latest.drop("row_id")


def first_detections(user_imei: DataFrame) -> DataFrame:
    return user_imei.groupBy("imei_number").agg(
        F.min("retrieved_datetime").alias("imei_first_detection_datetime")
    )


def with_corrected_installation(devices: DataFrame, detections: DataFrame) -> DataFrame:
    """Install time moved back to the first detection where that came earlier.

    least() skips nulls: a missing install time takes the first detection, a
    device never detected keeps its install time.
    """
    earliest = F.least("installation_datetime", "imei_first_detection_datetime")
    return devices.join(detections, "imei_number", "left").withColumn(
        "installation_datetime_final", earliest
    )


def exposure_with_devices(exposure: DataFrame, devices: DataFrame) -> DataFrame:
    """Every exposure row with the device rows of its item, if any."""
    installed = devices.select(
        F.col("item_no").alias("device_item_no"),
        "imei_first_detection_datetime",
        F.col("installation_datetime_final").alias("installation_datetime"),
    )
    return left_join_many(exposure, installed, "lob_asset_id", "device_item_no")


def latest_with_devices(exposure: DataFrame, devices: DataFrame) -> DataFrame:
    return exposure_with_devices(latest_exposure(exposure), devices)


def latest_with_devices_by_place(exposure: DataFrame, devices: DataFrame) -> DataFrame:
    """The rows of ``latest_with_devices`` in the columns of the mapping, stored.

    The exposure is stored once. Keys, what decides between rows and the rows'
    places go through the shuffles; the whole rows are not shuffled any more.
    """
    decide = [c for c in ("policy_version_number", *EXPOSURE_TIE_BREAKS) if c in exposure.columns]
    output = [RENAMED_IN_OUTPUT.get(c, c) for c in MAPPING_COLUMNS[:-1] if c not in FROM_DEVICES]
    whole = dict.fromkeys([*EXPOSURE_KEYS, *decide, *output])
    rows = freeze_placed(exposure.select(*whole), "exposure")
    latest = latest_exposure(rows.select(*EXPOSURE_KEYS, *decide, *PLACE))
    with lean(exposure.sparkSession):
        found = exposure_with_devices(latest.select("lob_asset_id", *PLACE), devices)
    return fetch_by_place(rows, found.select(*PLACE, *FROM_DEVICES), "mapping")


def build_policy_device_mapping(
    devices: DataFrame,
    user_imei: DataFrame,
    exposure: DataFrame,
    run_ts: Column,
    by_place: bool = False,
) -> DataFrame:
    """Latest exposure rows with corrected install times, one column list.

    ``run_ts`` is the time of the run; the same value lands in every row no
    matter how often the plan is executed. ``by_place`` is for exposures whose
    shuffled rows would fill the disks: these are stored before they are ranked.
    """
    featured = with_policy_features(renamed_exposure(exposure))
    corrected = with_corrected_installation(latest_devices(devices), first_detections(user_imei))
    join = latest_with_devices_by_place if by_place else latest_with_devices
    joined = join(featured, corrected)
    columns = {name: F.col(RENAMED_IN_OUTPUT.get(name, name)) for name in MAPPING_COLUMNS[:-1]}
    columns["inserted_timestamp"] = run_ts
    return joined.select(*[columns[name].alias(name) for name in MAPPING_COLUMNS])


def mapping_with_metrics(
    devices: DataFrame,
    user_imei: DataFrame,
    exposure: DataFrame,
    run_ts: Column,
    by_place: bool = False,
) -> tuple[DataFrame, dict]:
    """The mapping and row counters that fill while it is written."""
    counters = {}
    tables = {}
    for name, df in (("devices", devices), ("user_imei", user_imei), ("exposure", exposure)):
        tables[name], counters[name] = counted(df, f"{name}_rows")
    mapping = build_policy_device_mapping(
        tables["devices"], tables["user_imei"], tables["exposure"], run_ts, by_place
    )
    mapping, counters["mapping"] = counted(mapping, "mapping_rows")
    return mapping, counters
