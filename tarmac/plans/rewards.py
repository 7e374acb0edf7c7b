"""Monthly driving rewards, from trips to the rows of the rewards table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.cashback import cashback_ladder, scaling_factor, with_cashback
from tarmac.operators.clusters import nearest_center, score_centers, score_groups
from tarmac.operators.notrip import HAD_TRIPS, category, category_percent
from tarmac.operators.payout import (
    above_premium_floor,
    with_billing_columns,
    with_cycle,
    with_cycle_number,
    with_payout,
)
from tarmac.operators.scoring import driving_score, separation_weights
from tarmac.operators.trips import features_from_sums, month_and_history
from tarmac.schemas import REWARDS_SCHEMA
from tarmac.sources.session import freeze
from tarmac.sources.tables import conform

OF_CLIENTS_WITH_TRIPS = ("bandwidth", "earning_borderline_driving_score", "no_drivers_per_group")


def client_months(cohort: DataFrame, trips: DataFrame, month: str) -> DataFrame:
    """Cohort rows with their user's trip sums of the month and past-trip flags.

    The trips are read once and aggregated per user before they meet the cohort,
    so the trips themselves are never joined.
    """
    return cohort.join(month_and_history(trips, month), "sentiance_id", "left")


def features_of_month(cohort: DataFrame, trips: DataFrame, month: str) -> DataFrame:
    """Cohort rows with the month's features, null for clients without trips.

    The sums are frozen: every later step reads them several times, and the
    trips only once.
    """
    return features_from_sums(freeze(client_months(cohort, trips, month), "clients"))


def scored_clients(cohort: DataFrame, trips: DataFrame, month: str) -> DataFrame:
    """Clients with features and driving score, frozen with the learned weights."""
    features = features_of_month(cohort, trips, month)
    return freeze(driving_score(features, separation_weights(features)), "scored")


def frozen_ladder(with_center: DataFrame) -> DataFrame:
    """The ladder of the groups: one row per group, read by three later steps."""
    return freeze(cashback_ladder(score_groups(with_center)), "ladder")


def with_results(clients: DataFrame, centers: DataFrame) -> DataFrame:
    """Scored clients with groups, percents, amounts and classes."""
    grouped = nearest_center(clients, centers)
    had_trips = F.col("trip_count").isNotNull()
    ladder = frozen_ladder(grouped.filter(had_trips))
    with_amounts = with_cashback(grouped, ladder)
    factor = scaling_factor(with_amounts).select("scaling_factor").scalar()
    reward_category = F.when(had_trips, HAD_TRIPS).otherwise(
        category(F.col("drove_previous_month"))
    )
    percent = F.when(had_trips, F.col("cashback_percent")).otherwise(
        category_percent(F.col("reward_category"))
    )
    return (
        with_amounts.withColumn("reward_category", reward_category)
        .withColumn("cashback_percent", percent)
        .withColumn("cashback_amount", F.col("cashback_percent") * F.col("premium_collected"))
        .withColumn("scaling_factor", F.when(had_trips, factor))
        .withColumn(
            "scaled_cashback_amount",
            F.col("cashback_amount") * F.coalesce("scaling_factor", F.lit(1.0)),
        )
        .withColumn("no_trip_flag", F.when(had_trips, 0).otherwise(1))
        .withColumns({c: F.when(had_trips, F.col(c)) for c in OF_CLIENTS_WITH_TRIPS})
    )


def build_rewards(
    cohort: DataFrame,
    trips: DataFrame,
    month: str,
    calculated: Column,
    centers: DataFrame | None = None,
) -> DataFrame:
    """Rows of the rewards table for one month.

    Without ``centers`` the groups are fitted to all of the month's scores. Every client is one row from the cohort on, so the result needs
    no join back to premiums, exposure or the clients without trips.
    """
    clients = scored_clients(cohort, trips, month)
    if centers is None:
        centers = freeze(score_centers(clients, month), "centers")
    results = with_payout(with_billing_columns(with_results(clients, centers)))
    dated = with_cycle_number(with_cycle(results, month, calculated))
    return conform(above_premium_floor(dated), REWARDS_SCHEMA)
