"""Join forms that stay whole and balanced when a key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.sources.session import freeze

#: Buckets that the right rows of one key are dealt to, if there are more of them.
BUCKETS = 32


def left_join_many(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, buckets: int = BUCKETS
) -> DataFrame:
    """Left join on a key that may be hot on both sides, reading either side once.

    Right rows of a key that has more than ``buckets`` of them are dealt to buckets
    by their hash, and a left row goes to the buckets that its key has, never more
    often than it has partners. Without such keys it is a plain join. All joins can
    be split on their left side.
    """
    right = freeze(right, "right")
    bucket = F.pmod(F.xxhash64(*right.columns), F.lit(buckets)).cast("int")
    # stored, so that the planner knows its size: one row per key
    there = freeze(
        right.filter(F.col(right_key).isNotNull())
        .groupBy(F.col(right_key).alias("_there"))
        .agg(F.count("*").alias("_rows"), F.collect_set(bucket).alias("_buckets"))
        .filter(F.col("_rows") > buckets)
        .drop("_rows"),
        "buckets",
    )
    if there.isEmpty():
        return left.join(right, F.col(left_key) == F.col(right_key), "left")
    dealt = (
        right.join(there, F.col(right_key) == F.col("_there"), "left")
        .withColumn("_bucket", F.when(F.col("_there").isNull(), 0).otherwise(bucket))
        .drop("_there", "_buckets")
    )
    sent = (
        left.join(there, F.col(left_key) == F.col("_there"), "left")
        .withColumn("_sent", F.explode(F.coalesce("_buckets", F.array(F.lit(0)))))
        .drop("_there", "_buckets")
    )
    same = (F.col(left_key) == F.col(right_key)) & (F.col("_sent") == F.col("_bucket"))
    return sent.join(dealt, same, "left").drop("_sent", "_bucket")


def in_order(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """Preferred columns first, the others after them in their own order."""
    first = [c for c in preferred if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])
