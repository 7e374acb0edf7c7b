"""Global row numbers without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.sources.session import freeze

# monotonically_increasing_id() keeps the row's place in the low 33 bits.
_ROW_BITS = 33


def number_rows(df: DataFrame, order: Sequence[str], index: str = "row_index") -> DataFrame:
    """Number the rows 1, 2, ... in the given order.

    The rows must be distinct on ``order``. They are range-partitioned and
    sorted, each row's place in its slice is frozen together with the row,
    and a table of one row per slice adds the size of all earlier slices.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    frozen = freeze(placed, "numbered").withColumn(
        "_slice", F.shiftright("_place", _ROW_BITS)
    )
    sizes = frozen.groupBy("_slice").agg(F.count("*").alias("_size"))
    # one row per slice: bounded by the number of shuffle partitions
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    row_mask = F.lit((1 << _ROW_BITS) - 1)
    return frozen.join(F.broadcast(offsets), "_slice").select(
        *df.columns,
        (F.col("_offset") + F.col("_place").bitwiseAND(row_mask) + 1).alias(index),
    )


def global_dense_rank(df: DataFrame, order: Sequence[str], rank: str = "row_id") -> DataFrame:
    """Dense rank over the whole table, nulls last.

    Equal rows are reduced to one before numbering, so copies neither travel
    nor gather in one slice.
    """
    sort_nulls_last = [f"_is_null_{i}" for i, _ in enumerate(order)]
    flags = [F.col(c).isNull().alias(f) for c, f in zip(order, sort_nulls_last)]
    distinct = df.select(*order, *flags).distinct()
    interleaved = [c for pair in zip(sort_nulls_last, order) for c in pair]
    numbered = number_rows(distinct, interleaved, rank).select(
        *[F.col(c).alias(f"_of_{c}") for c in order], rank
    )
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in order]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return df.join(numbered, condition, "left").select(*df.columns, rank)
