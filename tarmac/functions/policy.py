"""Expressions over policy numbers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_dashes(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit(""))


def product_code(policy_no: Column) -> Column:
    """Leading letters of the policy number, '' when it starts otherwise."""
    return F.regexp_extract(without_dashes(policy_no), "^([A-Za-z]+)", 1)


def version_number(policy_no: Column) -> Column:
    """Number after the first slash, null when there is none."""
    return F.get(F.split(policy_no, "/"), F.lit(1)).try_cast("int")


def year_month(text: Column) -> Column:
    """Month as ``yyyyMM`` text, from ``yyyyMM`` or ``yyyy-MM``.

    Both spellings occur; text comparison only orders them once they agree.
    """
    return without_dashes(text.cast("string"))
