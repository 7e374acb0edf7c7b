"""The corpus pipeline: documents go through five operators, one after the other.

Each stage gets what its predecessor kept, as rows with the columns of
``documents``, and is written before the next one reads it. The last stage
returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import decontamination, language, packing, quality, simhash
from tarmac.llm.common import prepared, read, stored
from tarmac.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality ranking rejects."""
    prepared(spark)
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def identified_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, their ``lang`` replaced by the one identified.

    The sequences are packed by it; a document without letters has none.
    """
    prepared(spark)
    return language.keep_identified(docs, language.fit(docs), into="lang")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepared(spark)
    return simhash.keep_one(docs)


def uncontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of 4096 tokens of one language."""
    prepared(spark)
    return packing.pack(docs, tokenizer_path(), by="lang")


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("language", identified_documents),
    ("near_duplicates", distinct_documents),
    ("decontamination", uncontaminated_documents),
    ("packing", packed_sequences),
]

#: The stages learn models and pack sequences, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
