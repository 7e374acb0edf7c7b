"""From score groups to scaled cashback amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.numbers import money_sum, percent_of
from tarmac.operators.clusters import with_group_values

# Fixed values of the cashback rule.
LOWEST_PERCENT, HIGHEST_PERCENT = 0.05, 0.30
PAYING_FROM_SCORE = 0.5
TARGET_SHARE, SHARE_CEILING = 0.05, 0.06
CENTER_KEY_PLACES = 6


def center_label(center: Column) -> Column:
    return F.format_number(F.round(center, CENTER_KEY_PLACES), CENTER_KEY_PLACES)


def cashback_ladder(groups: DataFrame) -> DataFrame:
    """The group table with each group's cashback percent.

    Groups that reach below 0.5 get nothing. The others climb in equal steps
    from 5% to 30%; a single one gets 30%. The window runs over the group
    table, which holds at most one row per centre.
    """
    paying = F.col("min_ms_center") >= PAYING_FROM_SCORE
    among_paying = Window.partitionBy(paying)
    step = F.row_number().over(among_paying.orderBy("min_ms_center", "nearest_ms_center")) - 1
    steps = F.count(F.lit(1)).over(among_paying) - 1
    span = F.lit(HIGHEST_PERCENT - LOWEST_PERCENT)
    percent = (
        F.when(~paying, F.lit(0.0))
        .when(paying & (steps == 0), F.lit(HIGHEST_PERCENT))
        .when(paying, F.lit(LOWEST_PERCENT) + span * F.try_divide(step, steps))
    )
    return groups.withColumn("center_key", center_label(F.col("nearest_ms_center"))).withColumn(
        "cashback_percent", percent
    )


def earning_borderline(ladder: DataFrame) -> DataFrame:
    """One value: top score of the best group that earns nothing, else 0.5."""
    earning_nothing = ladder.filter(F.col("cashback_percent") == 0.0)
    return earning_nothing.agg(
        F.coalesce(
            F.max_by("max_ms_center", "nearest_ms_center"), F.lit(PAYING_FROM_SCORE)
        ).alias("earning_borderline_driving_score")
    )


def with_cashback(with_center: DataFrame, ladder: DataFrame) -> DataFrame:
    """Group range, percent, amount and borderline beside every row.

    Joined on the group number: two centres closer than six decimal places
    stay two groups.
    """
    ranged = with_group_values(with_center, ladder.drop("center_key"))
    percent = F.coalesce(F.col("cashback_percent"), F.lit(0.0))
    return (
        ranged.withColumn("cashback_percent", percent)
        .withColumn("cashback_amount", F.col("cashback_percent") * F.col("premium_collected"))
        .withColumn("earning_borderline_driving_score", earning_borderline(ladder).scalar())
    )


def scaling_factor(with_amounts: DataFrame) -> DataFrame:
    """One row: totals of the clients with trips, and the factor that meets the budget.

    A share of 5% to 6% of the premium stays; anything else is brought to
    5%. Without cashback or without premium the factor is 0.
    """
    totals = with_amounts.filter(F.col("trip_count").isNotNull()).agg(
        money_sum(F.col("premium_collected")).alias("total_premium"),
        money_sum(F.col("cashback_amount")).alias("total_cashback"),
    )
    premium = F.col("total_premium").cast("double")
    cashback = F.col("total_cashback").cast("double")
    share = F.try_divide(cashback, premium)
    factor = (
        F.when(share.between(TARGET_SHARE, SHARE_CEILING), F.lit(1.0))
        .when((cashback > 0) & (premium != 0), F.try_divide(premium * TARGET_SHARE, cashback))
        .otherwise(F.lit(0.0))
    )
    return totals.withColumn("cashback_share", share).withColumn("scaling_factor", factor)


def with_scaling(with_amounts: DataFrame, factor: DataFrame) -> DataFrame:
    """Scaled amounts of the clients with trips."""
    return (
        with_amounts.filter(F.col("trip_count").isNotNull())
        .withColumn("scaling_factor", factor.select("scaling_factor").scalar())
        .withColumn("scaled_cashback_amount", F.col("cashback_amount") * F.col("scaling_factor"))
    )


def cashback_totals(clients: DataFrame) -> DataFrame:
    """One row: premium and cashback of clients with trips, before and after scaling."""
    sums = clients.filter(F.col("trip_count").isNotNull()).agg(
        money_sum(F.col("premium_collected")).alias("total_premiums"),
        money_sum(F.col("cashback_amount")).alias("total_cashback_paid"),
        money_sum(F.col("scaled_cashback_amount")).alias("total_scaled_cashback_paid"),
    )
    premiums = F.col("total_premiums")
    return sums.withColumn(
        "cashback_pct",
        F.coalesce(percent_of(F.col("total_cashback_paid"), premiums), F.lit(0.0)),
    ).withColumn(
        "scaled_cashback_pct",
        F.coalesce(percent_of(F.col("total_scaled_cashback_paid"), premiums), F.lit(0.0)),
    )


def cashback_distribution(clients: DataFrame) -> DataFrame:
    """Number of clients per cashback percent."""
    return clients.groupBy("cashback_percent").agg(F.count("*").alias("num_clients"))
