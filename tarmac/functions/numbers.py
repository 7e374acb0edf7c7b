"""Numeric and hashing expressions."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-9
# Means of the same trips differ in the last bits with the order in which
# partitions are summed. Rounding here keeps ties ties on any cluster.
STABLE_PLACES = 10
MONEY_SUM_TYPE = "decimal(28,8)"

# Fixed values of the payout rule.
SMALLEST_PAID_AMOUNT = 10
MINIMUM_PAYOUT = 20


def stable(value: Column) -> Column:
    return F.round(value, STABLE_PLACES)


def share_of(part: Column, whole: Column) -> Column:
    """part / whole clamped to [0, 1], guarded against a zero whole."""
    return F.greatest(
        F.lit(0.0), F.least(F.lit(1.0), F.try_divide(part, whole + F.lit(EPSILON)))
    )


def money_sum(amount: Column) -> Column:
    """Sum that does not depend on the order of the rows."""
    return F.sum(amount.cast(MONEY_SUM_TYPE))


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole as a double, null when the whole is zero or null."""
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def stable_key(columns: Sequence[str], separator: str = "||") -> Column:
    """One text key; a missing part stays an empty part instead of vanishing."""
    return F.concat_ws(
        separator, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    )


def unit_hash(key: Column, method: str = "xxhash64") -> Column:
    """Hash of a text key, spread over [0, 1)."""
    if method == "xxhash64":
        # abs() of a double cannot overflow, unlike abs() of the smallest long
        return F.abs(F.xxhash64(key).cast("double")) / F.lit(float(2**63 - 1))
    if method == "md5":
        return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(
            float(2**32)
        )
    raise ValueError(f"unknown hash method: {method}")


def payout(amount: Column) -> Column:
    """Amount as paid: rounded, below 10 nothing, from 10 to 19 raised to 20."""
    rounded = F.round(amount)
    return (
        F.when(rounded < SMALLEST_PAID_AMOUNT, F.lit(0.0))
        .when(rounded < MINIMUM_PAYOUT, F.lit(float(MINIMUM_PAYOUT)))
        .otherwise(rounded)
    )
