"""Geocoded addresses and flood responses to one wide row per address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.responses import (
    flat_depths,
    flat_scores,
    merge_depths_and_scores,
    require_answered,
)


def build_flood_risk(
    geocoded: DataFrame,
    depth_responses: DataFrame,
    score_responses: DataFrame,
    run_ts: Column,
    when_one_side_empty: str = "nothing",
    outcomes: DataFrame | None = None,
) -> DataFrame:
    """Addresses with coordinates and an answer, the answer flattened beside them.

    With the ``outcomes`` of the request batches, one that failed for good stops the job.
    """
    if outcomes is not None:
        require_answered(outcomes)
    located = geocoded.dropna(subset=["lat", "lon"]).withColumn(
        "id", F.col("id").cast("string")
    )
    merged = merge_depths_and_scores(
        flat_depths(depth_responses), flat_scores(score_responses), when_one_side_empty
    )
    return (
        located.withColumnRenamed("id", "address_id")
        .join(merged, "address_id", "inner")
        .withColumn("risk_computed_at", run_ts)
    )
