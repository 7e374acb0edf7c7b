"""Checks and counts over tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def require_columns(df: DataFrame, required: Sequence[str], table: str) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{table} must contain columns {sorted(required)} (missing: {missing})")
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counted.filter(F.col("row_count") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table itself; fails when a key occurs twice."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"duplicate rows for {list(keys)}")
    return df


def row_count_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: row counts of two tables and whether the second is longer."""
    counted = after.agg(F.count("*").alias("rows_after")).withColumn(
        "rows_before", before.agg(F.count("*")).scalar()
    )
    return counted.select(
        "rows_before",
        "rows_after",
        (F.col("rows_after") - F.col("rows_before")).alias("rows_added"),
        (F.col("rows_after") > F.col("rows_before")).alias("inflated"),
    )


def not_covered(cohort: DataFrame, covered: DataFrame, key: str) -> DataFrame:
    """Ids of the cohort that no covering table holds."""
    return cohort.select(key).distinct().join(
        covered.select(key).distinct(), key, "left_anti"
    )


def distinct_counts(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row: number of distinct values per column, named by ``columns``."""
    return df.agg(*[F.count_distinct(c).alias(name) for c, name in columns.items()])


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, least and greatest value, in one pass."""
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.count(c).alias("value_count"),
                F.min(c).cast("double").alias("min_value"),
                F.max(c).cast("double").alias("max_value"),
            ).alias(c)
            for c in columns
        ]
    )
    return wide.select(F.inline(F.array(*columns)))


def null_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys with any missing value: missing values per column and in total."""
    counted = df.groupBy(*keys).agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]
    )
    total = F.lit(0)
    for c in columns:
        total = total + F.col(f"{c}_nulls")
    return counted.withColumn("total_nulls", total).filter(F.col("total_nulls") > 0)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The table with a row counter that fills while the table is used."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("row_count")), observation
