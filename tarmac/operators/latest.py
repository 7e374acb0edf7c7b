"""One row per key, chosen by a complete order.

``row_number() = 1`` is planned with a group limit before and after the
shuffle: every map task sends at most one row per key, so a key that holds a
third of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank_in_key"


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def keep_latest(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], tie_breaks: Sequence[str] = ()
) -> DataFrame:
    """Highest row per key. Tie-breaks that the table lacks are skipped."""
    order = [*by, *(c for c in tie_breaks if c in df.columns)]
    return _first_by(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_earliest(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], tie_breaks: Sequence[str] = ()
) -> DataFrame:
    """Lowest row per key, missing values last."""
    order = [*by, *(c for c in tie_breaks if c in df.columns)]
    return _first_by(df, keys, [F.col(c).asc_nulls_last() for c in order])


def first_value(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], alias: str | None = None
) -> DataFrame:
    """First present value per key in the given order, null if none is."""
    present = F.when(F.col(value).isNotNull(), F.struct(*order, value))
    return df.groupBy(*keys).agg(F.min(present)[value].alias(alias or value))


def earliest_with_minimum(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], minimum: str
) -> DataFrame:
    """Earliest row per key, its ``minimum`` column replaced by the key's least value.

    One aggregate instead of a ranked table joined to an aggregated one.
    """
    others = [c for c in df.columns if c not in keys and c != minimum]
    picked = F.min_by(F.struct(*others), F.struct(*by))
    grouped = df.groupBy(*keys).agg(picked.alias("_row"), F.min(minimum).alias(minimum))
    return grouped.select(
        *[
            F.col(c) if c in keys or c == minimum else F.col(f"_row.{c}").alias(c)
            for c in df.columns
        ]
    )
