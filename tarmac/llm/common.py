"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.harness import with_shared_folder
from tarmac.sources.session import adaptive, freeze

#: Rows of one Arrow batch: bounds what a Python worker holds of long texts.
BATCH_ROWS = "1000"


def prepared(spark: SparkSession) -> SparkSession:
    """Adaptive planning, and Arrow batches that stay small for long texts."""
    adaptive(with_shared_folder(spark)).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Written to the shared folder and read back: cuts lineage, survives lost executors."""
    return freeze(df, label, compression)


def utf8(column: str | Column) -> Column:
    """The bytes of a text; none for null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")).cast("binary")


def fold(key: str | Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as the empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    return df.mapInArrow(function, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, component) per node
    that has links, except the smallest node of each component, which names it.

    Alternates large-star and small-star steps; each round writes its edges, a
    tree of depth one at the end. Only counts and one checksum reach the driver.
    """
    a, b = F.col("a"), F.col("b")
    links = edges.filter(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    links = stored(links.distinct(), "links")
    before = None
    while True:
        mark = links.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("sum")
        ).first()
        if mark == before or mark["n"] == 0:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        before = mark
        ways = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = ways.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            ways.join(least, "u")
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .distinct()
        )
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi").filter(F.col("lo") != F.col("m"))
        links = stored(
            small.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(root.select("hi", F.col("m").alias("lo")))
            .distinct(),
            "links",
        )
