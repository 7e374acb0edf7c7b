"""The vehicles a month's rewards are calculated for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.dates import maturation_date, month_end
from tarmac.functions.policy import year_month
from tarmac.operators.latest import earliest_with_minimum, keep_latest
from tarmac.operators.quality import assert_unique, distinct_counts
from tarmac.schemas import POLICY_KEYS

ACTIVE_STATUS = "Policy"
LATEST_TIE_BREAKS = (
    "effective_year_month",
    "premium",
    "premium_collected",
    "imei_number",
    "original_lob_asset_id",
    "item_cancellation_date",
)
EARLIEST_ORDER = ("effective_year_month_int", "sentiance_id", "premium", "original_lob_asset_id")


def from_month(exposure: DataFrame, month: str) -> DataFrame:
    """Exposure rows of the month or later; both spellings of a month are read.

    The guard compares the stored text itself, so it prunes partitions and row
    groups. ``-`` sorts before digits: it lets both spellings of every wanted
    month through, and the exact test follows.
    """
    plain = month.replace("-", "")
    guard = F.col("effective_year_month") >= F.lit(f"{plain[:4]}-{plain[4:]}")
    if isinstance(exposure.schema["effective_year_month"].dataType, T.StringType):
        exposure = exposure.filter(guard)
    return exposure.withColumn(
        "effective_year_month", year_month(F.col("effective_year_month"))
    ).filter(F.col("effective_year_month") >= F.lit(plain))


def latest_exposure_rows(exposure: DataFrame) -> DataFrame:
    """Last inserted row per policy and item; within one load the latest month."""
    return keep_latest(
        exposure, ["policy_number", "item_no"], ["inserted_timestamp"], LATEST_TIE_BREAKS
    )


def with_device_user(exposure: DataFrame, user_imei: DataFrame) -> DataFrame:
    """Exposure rows whose device has a user, with that user's id.

    The user table holds a row per retrieval; the pairs are reduced before
    the join instead of multiplying the exposure.
    """
    pairs = user_imei.select("imei_number", "sentiance_id").distinct()
    return exposure.join(pairs, "imei_number", "inner")


def with_chosen_cancellation(exposure: DataFrame) -> DataFrame:
    """Earliest month's row per device, policy and item, with the earliest cancellation."""
    numbered = exposure.withColumn(
        "effective_year_month_int", F.col("effective_year_month").try_cast("int")
    )
    order = [c for c in EARLIEST_ORDER if c in numbered.columns]
    return earliest_with_minimum(
        numbered, POLICY_KEYS, order, "item_cancellation_date"
    ).drop("effective_year_month_int")


def active_cover(exposure: DataFrame, month: str) -> DataFrame:
    """Rows in force that stay uncancelled until the cycle matures."""
    dated = exposure.withColumn(
        "item_cancellation_date_cast", F.col("item_cancellation_date").try_cast("date")
    ).withColumn("maturation_date", maturation_date(month_end(month)))
    in_force = (F.trim("policy_status") == ACTIVE_STATUS) & (
        F.trim("cover_status") == ACTIVE_STATUS
    )
    lasts = F.col("item_cancellation_date_cast").isNull() | (
        F.col("maturation_date") <= F.col("item_cancellation_date_cast")
    )
    return dated.filter(in_force & lasts)


def build_cohort(
    exposure: DataFrame, user_imei: DataFrame, month: str, check_unique: bool = False
) -> DataFrame:
    """Vehicles in force until the cycle matures, one row per device, policy and item.

    ``check_unique`` counts the keys and stops on a repeated one, at the cost of
    another run of the plan; the rows are unique by construction.
    """
    latest = latest_exposure_rows(from_month(exposure, month))
    chosen = with_chosen_cancellation(with_device_user(latest, user_imei))
    if check_unique:
        assert_unique(chosen, POLICY_KEYS)
    return active_cover(chosen, month)


def cohort_counts(cohort: DataFrame) -> DataFrame:
    return distinct_counts(
        cohort,
        {
            "policy_number": "unique_policies",
            "imei_number": "unique_devices",
            "item_no": "unique_assets",
        },
    )
