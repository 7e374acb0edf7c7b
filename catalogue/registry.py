"""Names of the checked queries, each with its SQL twin where it has one.

``OPERATORS`` map a Testbed to the operator's own result; ``QUERIES`` return the
same in comparable form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.testbed import Testbed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
OPERATORS: dict[str, Callable[[Testbed], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a Testbed under a name."""

    def register(function: Callable[[Testbed], DataFrame]):
        OPERATORS[name] = function
        QUERIES[name] = lambda spark, folder: plain(function(Testbed(spark, folder)))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Values in types that compare alike in any engine.

    Decimals and doubles as doubles of six places, dates and times as text.
    Engines round exact halves differently, so halves are nudged up first.
    """
    return df.select(*[_plain(f).alias(f.name) for f in df.schema.fields])


def _plain(field: T.StructField):
    column = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
        return F.round(column.cast("double") + 1e-8, 6)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, T.DateType):
        return F.date_format(column, "yyyy-MM-dd")
    return column
