"""Learned component weights and the driving score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.numbers import EPSILON, stable
from tarmac.operators.latest import first_value
from tarmac.operators.quantiles import exact_quantiles, melted
from tarmac.schemas import POLICY_KEYS, SCORE_COMPONENTS

LOW_SHARE, HIGH_SHARE = 0.20, 0.80
DEGENERATE_TOTAL = 1e-12


def complete_rows(features: DataFrame, components: Sequence[str]) -> DataFrame:
    return features.dropna(subset=list(components))


def separation_weights(
    features: DataFrame, components: Sequence[str] = tuple(SCORE_COMPONENTS)
) -> DataFrame:
    """One row: a weight per component, summing to 1.

    A component weighs by how far its top and bottom fifth lie apart, in
    standard deviations. Equal weights when no component separates anything.
    """
    values = melted(complete_rows(features, components), components)
    fifths = (
        exact_quantiles(values, (LOW_SHARE, HIGH_SHARE))
        .groupBy("component")
        .agg(
            F.min_by("quantile", "share").alias("low"),
            F.max_by("quantile", "share").alias("high"),
        )
    )
    # one row per component, so it is sent to every executor
    beside = values.join(F.broadcast(fifths), "component")
    zero = F.lit(0.0)
    top = F.avg(F.when(F.col("value") >= F.col("high"), F.col("value")))
    bottom = F.avg(F.when(F.col("value") <= F.col("low"), F.col("value")))
    spread = F.greatest(F.coalesce(F.stddev_samp("value"), zero), F.lit(EPSILON))
    separation = F.abs(F.coalesce(top, zero) - F.coalesce(bottom, zero)) / spread
    raw = beside.groupBy("component").agg(separation.alias("raw"))
    row = raw.agg(
        F.sum("raw").alias("total"),
        *[F.sum(F.when(F.col("component") == c, F.col("raw"))).alias(c) for c in components],
    )
    separated = F.coalesce("total", zero) > DEGENERATE_TOTAL
    equal = F.lit(1.0 / len(components))
    return row.select(
        *[F.when(separated, F.col(c) / F.col("total")).otherwise(equal).alias(c) for c in components]
    )


def driving_score(
    features: DataFrame, weights: DataFrame, directions: Mapping[str, str] = SCORE_COMPONENTS
) -> DataFrame:
    """Weighted sum of the components, bad ones turned into 1 - x."""
    weighted = features.withColumn(
        "_w", weights.select(F.struct(*directions)).scalar()
    )
    score = F.lit(0.0)
    for c, direction in directions.items():
        good = F.lit(1.0) - F.col(c) if direction == "bad" else F.col(c)
        score = score + F.col("_w")[c] * good
    return weighted.withColumn("driving_score", stable(score)).drop("_w")


def score_summary(scored: DataFrame) -> DataFrame:
    """One row: least, mean, median, greatest and most frequent score."""
    present = scored.select("driving_score").dropna()
    median = exact_quantiles(melted(present, ["driving_score"]), (0.5,))
    frequency = present.groupBy("driving_score").agg(F.count("*").alias("n"))
    most_frequent = frequency.agg(
        F.max_by("driving_score", F.struct("n", (-F.col("driving_score")).alias("smallest")))
    )
    spread = present.agg(
        F.min("driving_score").alias("min_score"),
        F.avg("driving_score").alias("mean_score"),
        F.max("driving_score").alias("max_score"),
    )
    return spread.withColumn(
        "median_score", median.select("quantile").scalar()
    ).withColumn("mode_score", most_frequent.scalar())


def with_premium(
    features: DataFrame, exposure: DataFrame, order: Sequence[str], premium: str = "premium_collected"
) -> DataFrame:
    """Features and the first premium known for their policy, item and device.

    The right side holds each key once, so the row count stays as it is.
    """
    premiums = first_value(exposure, POLICY_KEYS, premium, order)
    return features.drop(premium).join(premiums, list(POLICY_KEYS), "left")


def without_score(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("driving_score").isNull())
