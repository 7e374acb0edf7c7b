"""Month and cycle arithmetic. A month is ``yyyyMM`` text or a text column."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.policy import year_month

# The cycle that ends in August 2025 is number 80.
BASE_CYCLE_YEAR, BASE_CYCLE_MONTH, BASE_CYCLE_NUMBER = 2025, 8, 80
MATURATION_MONTHS = 3
CYCLE_END_DAYS_BEFORE_MONTH_END = 3


def month_start(month: Column | str, offset: int = 0) -> Column:
    """First day of the month, ``offset`` months away.

    For a literal month this folds to a constant, so a comparison with a
    timestamp column reaches the parquet scan.
    """
    text = F.lit(month) if isinstance(month, str) else month
    first = F.to_date(F.concat(year_month(text), F.lit("01")), "yyyyMMdd")
    return F.add_months(first, offset) if offset else first


def month_end(month: Column | str) -> Column:
    return F.last_day(month_start(month))


def maturation_date(day: Column) -> Column:
    """Last day of the month that lies three months after ``day``."""
    return F.last_day(F.add_months(day, MATURATION_MONTHS))


def cycle_start(month: Column | str) -> Column:
    return month_start(month)


def cycle_end(month: Column | str) -> Column:
    """Fourth-last day of the month."""
    return F.date_sub(month_end(month), CYCLE_END_DAYS_BEFORE_MONTH_END)


def cycle_maturation(month: Column | str) -> Column:
    return maturation_date(month_end(month))


def cycle_number(cycle_end_date: Column) -> Column:
    base = BASE_CYCLE_YEAR * 12 + BASE_CYCLE_MONTH
    index = F.year(cycle_end_date) * 12 + F.month(cycle_end_date)
    return (index - F.lit(base) + F.lit(BASE_CYCLE_NUMBER)).cast("int")


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The column as a timestamp; unreadable text becomes null.

    Columns that already are timestamps pass through untouched, so that
    range filters on them still push down to the scan.
    """
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return column
    return column.try_cast("timestamp_ntz")


def in_month(moment: Column, month: str) -> Column:
    """Half-open range test: unlike year()/month(), it can be pushed down."""
    return (moment >= month_start(month)) & (moment < month_start(month, 1))
