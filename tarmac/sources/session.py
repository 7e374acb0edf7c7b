"""Session settings and frozen intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Joins on raw keys rely on the adaptive planner: it splits a join partition
# that a hot key has made too large, and picks broadcast joins from measured
# sizes. forceOptimizeSkewedJoin lets it do so even when the split costs a
# further shuffle.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

#: While own copies of large tables are written: shuffle files go when the copy is there,
#: and a task whose rows have one bucket writes them unsorted.
LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "1",
}
#: While rows are fetched by place: they stay where they are bucketed, by task alone. Joins
#: that are dealt out by more columns than their key must not run under it.
IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
#: Where a row of a placed table lies: the task that wrote it and the row's number.
PLACE = ("_task", "_row")

_SCOPES: list[list[str]] = []


def adaptive(spark: SparkSession) -> SparkSession:
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def lean(spark: SparkSession, more: Mapping[str, str] | None = None) -> Iterator[None]:
    """The settings of ``LEAN``, and ``more``, for what is executed inside."""
    values = {**LEAN, **(more or {})}
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: that of ``spark.checkpoint.dir``, else that of
    the context's ``setCheckpointDir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/tarmac/{label}-{uuid.uuid4().hex}"
    for paths in _SCOPES:
        paths.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the own copies that were made inside when the block ends.

    Write the result to a table of its own before that: its plan reads them.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def freeze(df: DataFrame, label: str = "frozen", compression: str | None = None) -> DataFrame:
    """Write the table to the shared folder and read it back.

    Cuts the lineage: several later passes read the result instead of
    repeating the work, each only the columns it needs, and losing an
    executor loses nothing.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freeze_placed(df: DataFrame, label: str = "placed") -> DataFrame:
    """The table written to the shared folder, each row with its place (``PLACE``).

    Narrow columns and the place can then be shuffled and joined instead of whole
    rows, which ``fetch_by_place`` adds at the end. The copy is bucketed by the
    writing task.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    task, row = PLACE
    placed = df.withColumns({task: F.spark_partition_id(), row: F.monotonically_increasing_id()})
    writer = placed.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), task)
    with lean(spark):
        writer.option("path", fresh_path(spark, label)).option("compression", "zstd").saveAsTable(name)
    stored = spark.read.table(name)
    spark.sql(f"drop table {name}")  # the files stay
    return stored


def fetch_by_place(placed: DataFrame, found: DataFrame, label: str = "fetched") -> DataFrame:
    """Rows of a placed table whose places are in ``found``, with its columns, stored.

    Only ``found`` is shuffled.
    """
    spark = placed.sparkSession
    with lean(spark):
        found = freeze(found, "found", "zstd")
    with lean(spark, IN_PLACE):
        fetched = placed.join(found.hint("shuffle_hash"), list(PLACE))
        return freeze(fetched.drop(*PLACE), label, "zstd")
