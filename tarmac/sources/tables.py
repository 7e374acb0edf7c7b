"""Scans and sinks for catalog and parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.latest import keep_earliest


def quoted(name: str) -> str:
    """Back-ticked table name; double quotes would read as a string."""
    return ".".join(f"`{part.strip('`')}`" for part in name.strip('"').split("."))


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(quoted(name))


def scan_sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Scan by SQL text; ``tables`` are DataFrames named in braces in the text."""
    return spark.sql(text, **tables)


def scan_all(spark: SparkSession, name: str) -> DataFrame:
    return scan_sql(spark, f"select * from {quoted(name)}")


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table, schema included."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``.

    Rows are gathered by partition value first, so that each output folder
    gets a few large files instead of one per task; the rebalance splits a
    value that holds much more than the others.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def overwrite_table(
    df: DataFrame, name: str, comment: str | None = None, path: str | None = None
) -> None:
    """Replace a catalog table, schema included; ``path`` keeps its files in that folder."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    if comment:
        writer = writer.option("comment", comment)
    writer.saveAsTable(quoted(name))


def rows_to_insert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    within: str | None = None,
) -> DataFrame:
    """Source rows whose key the target lacks, one row per key.

    ``order`` decides which of several source rows with one key is taken. Only the
    part of the target is read whose ``within``, one of the keys, lies in the range
    of the source; a target partitioned by it is pruned.
    """
    if within is not None:
        if within not in keys:
            raise ValueError(f"{within} is none of the keys")
        least, most = source.agg(F.min(within)).scalar(), source.agg(F.max(within)).scalar()
        target = target.filter((F.col(within) >= least) & (F.col(within) <= most))
    reduced = keep_earliest(source, keys, order or [c for c in source.columns if c not in keys])
    return reduced.join(target.select(*keys).distinct(), list(keys), "left_anti").select(
        *source.columns
    )


def insert_only_merge(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    partition_by: str | None = None,
) -> None:
    """Append to the parquet table the source rows whose key it lacks.

    A table partitioned by one of the keys is read only in the partitions that
    the source may fill.
    """
    spark = source.sparkSession
    target = spark.read.schema(source.schema).parquet(path)
    writer = rows_to_insert(target, source, keys, order, partition_by).write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def rename_known(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist, in one projection."""
    return df.withColumnsRenamed(dict(names))


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns, order and types of the schema; fails where a column is missing."""
    return df.to(T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))
