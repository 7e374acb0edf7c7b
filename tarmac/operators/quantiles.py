"""Exact quantiles of several columns without sorting any of them whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rank error of the sketch is at most count / ACCURACY on either side, so the
# exact quantile always lies in a band of twice that width around its rank.
ACCURACY = 10_000
_BAND = 2.0 / ACCURACY
# A bracket is cut to about three of so many steps.
STEPS = 256


def melted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (component, value) per present value of the columns."""
    pairs = ", ".join(f"struct('{c}' as component, cast({c} as double) as value)" for c in columns)
    return df.select(F.expr(f"inline(array({pairs}))")).filter(F.col("value").isNotNull())


def exact_quantiles(values: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Per component and share the smallest value that reaches the share.

    A mergeable sketch brackets every quantile, and a second sketch of the values
    in the bracket narrows it. Only values inside the narrow brackets are then
    counted, one row per distinct value, on top of one count of all values below.
    Each pass aggregates before it shuffles and reads ``values`` once.
    """
    bounds = [x for p in shares for x in (max(0.0, p - _BAND), min(1.0, p + _BAND))]
    sketch = values.groupBy("component").agg(
        F.count("*").alias("n"), F.percentile_approx("value", bounds, ACCURACY).alias("bound")
    )
    brackets = ", ".join(
        f"struct({p}D as share, bound[{2 * i}] as low, bound[{2 * i + 1}] as high)"
        for i, p in enumerate(shares)
    )
    bands = narrowed(values, sketch.select("component", "n", F.expr(f"inline(array({brackets}))")))
    # one row per component and share, so it is sent to every executor
    beside = values.join(F.broadcast(bands), "component").filter(F.col("value") <= F.col("high"))
    inside = F.when(F.col("value") >= F.col("low"), F.col("value"))
    counted = beside.groupBy("component", "share", "n", inside.alias("value")).agg(
        F.count("*").alias("copies")
    )
    upto = (
        Window.partitionBy("component", "share")
        .orderBy(F.col("value").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = counted.withColumn("rank", F.sum("copies").over(upto))
    reached = (F.col("rank") >= F.col("share") * F.col("n")) & F.col("value").isNotNull()
    return (
        ranked.filter(reached)
        .groupBy("component", "share")
        .agg(F.min("value").alias("quantile"))
    )


def narrowed(values: DataFrame, bands: DataFrame) -> DataFrame:
    """The brackets cut to the steps around the wanted rank, of a sketch inside each."""
    c = F.col
    # one row per component and share, so it is sent to every executor
    beside = values.join(F.broadcast(bands), "component").filter(c("value") <= c("high"))
    steps = [i / STEPS for i in range(STEPS + 1)]
    inside = F.when(c("value") >= c("low"), c("value"))
    marked = beside.groupBy("component", "share", "n", "low", "high").agg(
        F.count_if(c("value") < c("low")).alias("below"),
        F.count(inside).alias("inside"),
        F.percentile_approx(inside, steps, ACCURACY).alias("marks"),
    )
    at = (c("share") * c("n") - c("below")) / F.greatest(c("inside"), F.lit(1))
    first = F.floor((at - _BAND) * STEPS).cast("int")
    last = F.ceil((at + _BAND) * STEPS).cast("int")
    return marked.select(
        "component",
        "n",
        "share",
        F.when(first > 0, F.get("marks", first)).otherwise(c("low")).alias("low"),
        F.when(last < STEPS, F.get("marks", F.greatest(last, F.lit(0)))).otherwise(c("high")).alias("high"),
    )
