"""Score groups: sample, histogram, bandwidth, centres, nearest centre, group ranges.

The fit reads every scored client, as a histogram: one row per occupied cell of
a fixed width. Its size depends on that width and the range of the scores, never
on the number of clients, so the fit of a month is one small group.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.numbers import stable_key, unit_hash

# Fixed values of the fit.
HALVINGS = 60
SAMPLE_SHARE = 0.20
SCORE_PLACES = 8
NEIGHBOUR_SHARE = 0.30
MAX_STEPS = 300
STOP_SHARE_OF_BANDWIDTH = 1e-3
#: Width of a histogram cell. Scores of one cell count as their mean, so the
#: bandwidth and the centres are exact to about this width.
CELL = 1e-4
#: No bandwidth is smaller, so groups number at most the score range over this.
SMALLEST_BANDWIDTH = 1e-3

KEY_PARTS = ("policy_number", "item_no", "imei_number", "sentiance_id")

# executors need no installed copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def with_stable_key(scored: DataFrame) -> DataFrame:
    return scored.withColumn("driving_score", F.col("driving_score").cast("double")).withColumn(
        "stable_key", stable_key(KEY_PARTS)
    )


def score_sample(
    scored: DataFrame, method: str = "xxhash64", share: float = SAMPLE_SHARE
) -> DataFrame:
    """The same share of the scored rows on every run, chosen by the hash of their key."""
    keyed = with_stable_key(scored).filter(F.col("driving_score").isNotNull())
    return (
        keyed.withColumn("unit_hash", unit_hash(F.col("stable_key"), method))
        .filter(F.col("unit_hash") < share)
        .select("stable_key", "unit_hash", "driving_score")
    )


def score_histogram(scored: DataFrame, month: str, cell: float = CELL) -> DataFrame:
    """Occupied cells of the month's scores: reward_month, value (their mean), clients."""
    score = F.col("driving_score").cast("double")
    return (
        scored.filter(score.isNotNull())
        .groupBy(F.floor(score / cell).alias("cell"))
        .agg(F.sum(score).alias("total"), F.count("*").alias("clients"))
        .select(
            F.lit(month).alias("reward_month"),
            F.round(F.col("total") / F.col("clients"), SCORE_PLACES).alias("value"),
            "clients",
        )
    )


def neighbour_bandwidth(values: np.ndarray, weights: np.ndarray) -> float:
    """Mean distance to the 30%-nearest neighbour; normal-scale rule if that is 0.

    Each value stands for as many clients as its weight. The reach of a value is
    the least distance within which that many clients lie, itself included.
    """
    order = np.argsort(values)
    x, w = values[order], weights[order].astype(float)
    before = np.concatenate([[0.0], np.cumsum(w)])
    count = before[-1]
    k = max(int(count * NEIGHBOUR_SHARE), 1)
    low, reach = np.full(len(x), -1.0), np.full(len(x), x[-1] - x[0])
    for _ in range(HALVINGS):
        middle = (low + reach) / 2
        last = np.searchsorted(x, x + middle, "right")
        enough = before[last] - before[np.searchsorted(x, x - middle, "left")] >= k
        reach, low = np.where(enough, middle, reach), np.where(enough, low, middle)
    reach = np.maximum(reach, 0.0)
    bandwidth = float((reach * w).sum() / count)
    if bandwidth <= 0:
        mean = (x * w).sum() / count
        spread = np.sqrt((w * (x - mean) ** 2).sum() / (count - 1)) if count > 1 else 0.0
        bandwidth = 1.06 * spread * count ** (-0.2)
    return float(np.round(max(bandwidth, SMALLEST_BANDWIDTH), SCORE_PLACES))


def mean_shift(values: np.ndarray, weights: np.ndarray, bandwidth: float) -> list[float]:
    """Flat-kernel mean shift in one dimension on weighted values, ascending centres.

    Seeds are the occupied cells of a grid as wide as the bandwidth. Each
    moves to the mean of the points in reach until it rests; one that does not
    rest stops the fit. Of resting places within one bandwidth of each other
    the one with more points in reach stays, then the greater one.
    """
    order = np.argsort(values)
    x, w = values[order], weights[order].astype(float)
    weight_before = np.concatenate([[0.0], np.cumsum(w)])
    sum_before = np.concatenate([[0.0], np.cumsum(w * x)])
    resting = {}
    for centre in (np.unique(np.round(x / bandwidth)) * bandwidth).tolist():
        for _ in range(MAX_STEPS + 1):
            lo = np.searchsorted(x, centre - bandwidth, "left")
            hi = np.searchsorted(x, centre + bandwidth, "right")
            inside = weight_before[hi] - weight_before[lo]
            if inside == 0:
                break
            moved = float((sum_before[hi] - sum_before[lo]) / inside)
            step, centre = abs(moved - centre), moved
            if step <= STOP_SHARE_OF_BANDWIDTH * bandwidth:
                resting[centre] = inside
                break
        else:
            raise RuntimeError(f"a centre near {centre} does not rest after {MAX_STEPS} steps")
    kept: list[float] = []
    for centre, _ in sorted(resting.items(), key=lambda c: (c[1], c[0]), reverse=True):
        if all(abs(centre - other) > bandwidth for other in kept):
            kept.append(centre)
    return sorted(kept)


def fit_month(month: str, histogram: pd.DataFrame) -> pd.DataFrame:
    values, clients = histogram["value"].to_numpy(), histogram["clients"].to_numpy()
    bandwidth = neighbour_bandwidth(values, clients)
    centres = mean_shift(values, clients, bandwidth)
    return pd.DataFrame(
        {
            "reward_month": month,
            "bandwidth": bandwidth,
            "ms_cluster": np.arange(len(centres), dtype="int32"),
            "ms_center": centres,
        }
    )


CENTERS_SCHEMA = "reward_month string, bandwidth double, ms_cluster int, ms_center double"


def score_centers(scored: DataFrame, month: str, cell: float = CELL) -> DataFrame:
    """Bandwidth and group centres of all of the month's scores, ascending."""
    return (
        score_histogram(scored, month, cell)
        .groupBy("reward_month")
        .applyInPandas(lambda key, pdf: fit_month(key[0], pdf), CENTERS_SCHEMA)
    )


def fixed_centers(df: DataFrame, month: str, bandwidth: float, centers: list[float]) -> DataFrame:
    """Centres given as parameters, in the form the fit returns."""
    rows = [(month, bandwidth, i, float(c)) for i, c in enumerate(sorted(centers))]
    return df.sparkSession.createDataFrame(rows, CENTERS_SCHEMA)


def nearest_center(scored: DataFrame, centers: DataFrame) -> DataFrame:
    """Nearest centre, distance and number of each score; the smaller centre on ties.

    The centres travel as one array: fitted ones lie at least the smallest
    bandwidth apart, so their number is bounded by the score range.
    """
    listed = centers.dropna(subset=["ms_cluster", "ms_center"]).agg(
        F.struct(
            F.max("bandwidth").alias("bandwidth"),
            F.array_sort(F.collect_set(F.struct("ms_center", "ms_cluster"))).alias("centers"),
        )
    )

    def candidate(center: Column) -> Column:
        gap = F.abs(F.col("driving_score") - center["ms_center"])
        return F.struct(gap.alias("gap"), center["ms_center"], center["ms_cluster"])

    nearest = F.when(
        F.col("driving_score").isNotNull(),
        F.array_min(F.transform(F.col("_fit.centers"), candidate)),
    )
    return (
        scored.withColumn("driving_score", F.col("driving_score").cast("double"))
        .withColumn("_fit", listed.scalar())
        .withColumn("bandwidth", F.col("_fit.bandwidth"))
        .withColumn("_nearest", nearest)
        .withColumn("nearest_ms_center", F.col("_nearest.ms_center"))
        .withColumn("ms_center_gap", F.col("_nearest.gap"))
        .withColumn("nearest_ms_cluster", F.col("_nearest.ms_cluster"))
        .drop("_fit", "_nearest")
    )


def score_groups(with_center: DataFrame) -> DataFrame:
    """One row per group: its score range and size."""
    return with_center.groupBy("nearest_ms_cluster", "nearest_ms_center").agg(
        F.min("driving_score").alias("min_ms_center"),
        F.max("driving_score").alias("max_ms_center"),
        F.count(F.lit(1)).alias("no_drivers_per_group"),
    )


def with_group_values(with_center: DataFrame, groups: DataFrame) -> DataFrame:
    """Values of the group table beside every row.

    Aggregated and sent back instead of a window per group, which would put
    all drivers of a group into one task. The planner picks the join by the
    measured size of the table.
    """
    values = groups.drop("nearest_ms_center").withColumnRenamed("nearest_ms_cluster", "_cluster")
    return with_center.join(
        values, F.col("nearest_ms_cluster").eqNullSafe(F.col("_cluster")), "left"
    ).drop("_cluster")
