"""What is paid, and the reports on it."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.dates import cycle_end, cycle_maturation, cycle_number, cycle_start
from tarmac.functions.numbers import money_sum, payout
from tarmac.operators.latest import keep_latest
from tarmac.schemas import POLICY_KEYS

# Bucket labels and the smallest premium that takes part.
EARNS = "Earn > 0"
ZERO_NO_PREMIUM = "Zero — no premium_collected"
ZERO_MODEL = "Zero — model 0%"
REASON_NO_PREMIUM = "Zero due to no premium_collected"
REASON_MODEL = "Zero due to model 0%"
PREMIUM_FLOOR = Decimal("1.84")

EXPOSURE_DETAILS = ("premium", "item_description", "original_lob_asset_id")


def with_charged_premium(
    results: DataFrame, exposure: DataFrame, order: Sequence[str]
) -> DataFrame:
    """Charged premium, item text and asset id beside each result.

    The exposure is first reduced to one row per policy, item and device, so
    the join adds no rows.
    """
    details = keep_latest(
        exposure.select(*POLICY_KEYS, *EXPOSURE_DETAILS, *order), POLICY_KEYS, order
    ).select(*POLICY_KEYS, *EXPOSURE_DETAILS)
    joined = results.drop(*EXPOSURE_DETAILS).join(details, list(POLICY_KEYS), "left")
    return with_billing_columns(joined)


def with_billing_columns(results: DataFrame) -> DataFrame:
    return results.withColumnRenamed("premium", "premium_charged").withColumn(
        "premium_collected", F.round("premium_collected", 2)
    )


def with_payout(results: DataFrame) -> DataFrame:
    return results.withColumn("cycle_reward_thresh", payout(F.col("scaled_cashback_amount")))


def no_premium() -> Column:
    collected = F.coalesce(F.col("premium_collected").cast("double"), F.lit(0.0))
    return collected <= 0


def payout_buckets(paid: DataFrame) -> DataFrame:
    """Clients per payout bucket with the ranges of premium and payout."""
    bucket = (
        F.when(F.col("cycle_reward_thresh") > 0, EARNS)
        .when(no_premium(), ZERO_NO_PREMIUM)
        .otherwise(ZERO_MODEL)
    )
    return paid.groupBy(bucket.alias("payout_bucket")).agg(
        F.count("*").alias("num_clients"),
        F.min(F.col("premium_collected").cast("double")).alias("min_premium_collected"),
        F.max(F.col("premium_collected").cast("double")).alias("max_premium_collected"),
        F.min("cycle_reward_thresh").alias("min_cycle_reward_thresh"),
        F.max("cycle_reward_thresh").alias("max_cycle_reward_thresh"),
    )


def zero_reasons(paid: DataFrame) -> DataFrame:
    """Why clients get nothing, counted."""
    reason = F.when(no_premium(), REASON_NO_PREMIUM).otherwise(REASON_MODEL)
    return (
        paid.filter(F.col("cycle_reward_thresh") <= 0)
        .groupBy(reason.alias("reason"))
        .agg(F.count("*").alias("num_clients"))
    )


def premium_totals(paid: DataFrame) -> DataFrame:
    """One row: premium charged and collected, and the least collected."""
    return paid.agg(
        money_sum(F.col("premium_charged")).alias("total_premium_charged"),
        money_sum(F.col("premium_collected")).alias("total_premium_collected"),
        F.min("premium_collected").alias("min_premium_collected"),
        F.count_if(F.col("premium_collected") < 0).alias("negative_premiums"),
        F.count_if(F.col("premium_collected") == 0).alias("zero_premiums"),
    )


def with_cycle(results: DataFrame, month: str, calculated: Column) -> DataFrame:
    """Cycle dates of the reward month and the time of the calculation."""
    return results.withColumns(
        {
            "cycle_start_date": cycle_start(month),
            "cycle_end_date": cycle_end(month),
            "cycle_maturation_date": cycle_maturation(month),
            "calculated_datetime": calculated,
        }
    )


def with_cycle_number(results: DataFrame) -> DataFrame:
    return results.withColumn("cycle_number", cycle_number(F.col("cycle_end_date")))


def above_premium_floor(results: DataFrame) -> DataFrame:
    return results.filter(F.col("premium_collected") > F.lit(PREMIUM_FLOOR))


def up_to_premium_floor(results: DataFrame) -> DataFrame:
    return results.filter(F.col("premium_collected") <= F.lit(PREMIUM_FLOOR))
