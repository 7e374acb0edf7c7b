"""Cohort, trips, score, groups, cashback, classes, payout and the merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.sql import DRIVER, FITTED, MEASURES, select, with_tables
from catalogue.testbed import (
    FIXED_BANDWIDTH,
    FIXED_CENTERS,
    REWARD_MONTH,
    Testbed,
    run_ts,
)
from tarmac.functions.dates import (
    cycle_end,
    cycle_maturation,
    cycle_number,
    cycle_start,
    month_end,
    month_start,
)
from tarmac.operators.cashback import (
    cashback_distribution,
    cashback_ladder,
    cashback_totals,
    earning_borderline,
    scaling_factor,
    with_cashback,
    with_scaling,
)
from tarmac.operators.clusters import (
    fixed_centers,
    nearest_center,
    score_centers,
    score_groups,
    score_sample,
    with_group_values,
    with_stable_key,
)
from tarmac.operators.notrip import (
    all_clients,
    month_totals,
    no_trip_rewards,
    no_trip_summary,
    union_results,
)
from tarmac.operators.payout import (
    above_premium_floor,
    payout_buckets,
    premium_totals,
    up_to_premium_floor,
    with_charged_premium,
    with_cycle,
    with_cycle_number,
    with_payout,
    zero_reasons,
)
from tarmac.operators.quality import not_covered, null_counts, profile
from tarmac.operators.ranking import global_dense_rank
from tarmac.operators.scoring import (
    score_summary,
    separation_weights,
    with_premium,
    without_score,
)
from tarmac.operators.trips import (
    cohort_trips,
    fill_gaps,
    newest_trip,
    trips_of_month,
)
from tarmac.plans.cohort import (
    active_cover,
    build_cohort,
    cohort_counts,
    from_month,
    latest_exposure_rows,
    with_chosen_cancellation,
    with_device_user,
)
from tarmac.plans.rewards import (
    build_rewards,
    features_of_month,
    frozen_ladder,
    scored_clients,
)
from tarmac.schemas import DRIVER_KEYS, LATE_DRIVE, REWARD_KEYS, REWARDS_SCHEMA, TRIP_MEASURES
from tarmac.sources.session import freeze, fresh_path
from tarmac.sources.tables import empty_table, insert_only_merge

EXPOSURE = """policy_number, item_no, imei_number, effective_year_month, policy_status,
cover_status, t:item_cancellation_date, r:premium, r:premium_collected, item_description,
original_lob_asset_id, t:inserted_timestamp"""
FEATURES = f"""{DRIVER}, r:avg_hard_accel, r:avg_hard_brake, r:avg_legal,
r:avg_overall_score, any_late_drive, r:total_distance, r:total_trip_duration,
r:total_late_drive_duration, trip_count, r:late_drive_ratio"""
SCORED = f"{FEATURES}, r:driving_score"
NEAREST = "r:bandwidth, nearest_ms_cluster, r:nearest_ms_center, r:ms_center_gap"
RANGES = "r:min_ms_center, r:max_ms_center, no_drivers_per_group"
AMOUNTS = f"""{SCORED}, {NEAREST}, {RANGES}, r:premium_collected, r:cashback_percent,
r:cashback_amount, r:earning_borderline_driving_score"""
CLIENTS = f"{AMOUNTS}, r:scaling_factor, r:scaled_cashback_amount, no_trip_flag"
RESULTS = f"{CLIENTS}, reward_category"
ENRICHED = f"{RESULTS}, r:premium_charged, item_description, original_lob_asset_id"
REWARDS = f"""{ENRICHED.replace("any_late_drive", "s:any_late_drive")}, r:cycle_reward_thresh, d:cycle_start_date, d:cycle_end_date, d:cycle_maturation_date,
t:calculated_datetime, cycle_number"""


# ---- tables the queries share -------------------------------------------------


def exposure_users(tb: Testbed) -> DataFrame:
    return with_device_user(
        latest_exposure_rows(from_month(tb.exposure(), REWARD_MONTH)), tb.user_imei()
    )


def all_months_chosen(tb: Testbed) -> DataFrame:
    return with_chosen_cancellation(
        with_device_user(from_month(tb.exposure(), REWARD_MONTH), tb.user_imei())
    )


def cohort(tb: Testbed) -> DataFrame:
    stored = tb.known("cohort")
    if stored is not None:
        return stored
    return build_cohort(tb.exposure(), tb.user_imei(), REWARD_MONTH)


def stored_cohort(tb: Testbed) -> DataFrame:
    """The cohort for queries that read it in several steps."""
    return tb.frozen("cohort", lambda: cohort(tb))


def month_trips(tb: Testbed) -> DataFrame:
    return cohort_trips(cohort(tb), trips_of_month(tb.trips(), REWARD_MONTH))


def had_trips(df: DataFrame) -> DataFrame:
    return df.filter(F.col("trip_count").isNotNull())


def features(tb: Testbed) -> DataFrame:
    return had_trips(features_of_month(cohort(tb), tb.trips(), REWARD_MONTH))


def scored(tb: Testbed) -> DataFrame:
    return had_trips(scored_clients(cohort(tb), tb.trips(), REWARD_MONTH))


def centers(tb: Testbed) -> DataFrame:
    empty = tb.spark.createDataFrame([], "x int")
    return fixed_centers(empty, REWARD_MONTH, FIXED_BANDWIDTH, FIXED_CENTERS)


def nearest(tb: Testbed) -> DataFrame:
    return nearest_center(scored(tb), centers(tb))


def amounts(tb: Testbed) -> DataFrame:
    near = nearest(tb)
    return with_cashback(near, frozen_ladder(near))


def scaled(tb: Testbed) -> DataFrame:
    with_amounts = amounts(tb)
    return with_scaling(with_amounts, scaling_factor(with_amounts))


MONTHLY_RESULT = (
    *DRIVER_KEYS, "avg_hard_accel", "avg_hard_brake", "avg_legal", "avg_overall_score",
    "any_late_drive", "total_distance", "total_trip_duration", "total_late_drive_duration",
    "trip_count", "late_drive_ratio", "driving_score", "bandwidth", "nearest_ms_cluster",
    "nearest_ms_center", "ms_center_gap", "min_ms_center", "max_ms_center",
    "no_drivers_per_group", "premium_collected", "cashback_percent", "cashback_amount",
    "earning_borderline_driving_score", "scaling_factor", "scaled_cashback_amount",
)


def clients(tb: Testbed) -> DataFrame:
    members = stored_cohort(tb)
    return all_clients(members, scaled(tb).select(*MONTHLY_RESULT))


def no_trips(tb: Testbed) -> DataFrame:
    return no_trip_rewards(clients(tb), tb.trips(), REWARD_MONTH)


def results(tb: Testbed) -> DataFrame:
    everyone = clients(tb)
    return union_results(everyone, no_trip_rewards(everyone, tb.trips(), REWARD_MONTH))


def enriched(tb: Testbed) -> DataFrame:
    members = stored_cohort(tb)
    return with_charged_premium(results(tb), members, ["effective_year_month"])


def paid(tb: Testbed) -> DataFrame:
    return with_payout(enriched(tb))


def rewards(tb: Testbed) -> DataFrame:
    return build_rewards(cohort(tb), tb.trips(), REWARD_MONTH, run_ts(), centers(tb))


# ---- cohort -------------------------------------------------------------------


@query("exposure_latest", select(EXPOSURE, "exposure_latest"))
def exposure_latest(tb):
    return latest_exposure_rows(from_month(tb.exposure(), REWARD_MONTH))


@query("exposure_users", select(EXPOSURE + ", sentiance_id", "exposure_users"))
def exposure_with_users(tb):
    return exposure_users(tb)


@query("exposure_cancel_date", select(EXPOSURE + ", sentiance_id", "chosen_of_all_months"))
def exposure_cancel_date(tb):
    return all_months_chosen(tb)


COHORT = EXPOSURE + ", sentiance_id, d:item_cancellation_date_cast, d:maturation_date"


@query(
    "exposure_active",
    select(COHORT, "cohort"),
)
def exposure_active(tb):
    return active_cover(with_chosen_cancellation(exposure_users(tb)), REWARD_MONTH)


@query("cohort_full", select(COHORT, "cohort"))
def cohort_full(tb):
    return cohort(tb)


@query(
    "cohort_counts",
    with_tables("""
select count(distinct policy_number) as unique_policies,
       count(distinct imei_number) as unique_devices, count(distinct item_no) as unique_assets
from cohort"""),
)
def counts_of_cohort(tb):
    return cohort_counts(cohort(tb))


# ---- trips and features -------------------------------------------------------


@query(
    "latest_trip",
    with_tables("""
select sentiance_id, start_ts, end_ts, round(distance + 1e-8, 6) as distance,
       end_ts || '.000000' as end_ts_cast
from trips order by cast(end_ts as timestamp) desc, start_ts desc, sentiance_id desc limit 1"""),
)
def latest_trip(tb):
    return newest_trip(tb.trips(), ["start_ts", "sentiance_id"]).select(
        "sentiance_id", "start_ts", "end_ts", "distance", "end_ts_cast"
    )


TRIP_VALUES = ", ".join(f"r:{c}" for c in MEASURES) + ", late_drive"


@query(
    "trips_in_month",
    select(f"{DRIVER}, start_ts, end_ts, {TRIP_VALUES}", "cohort_trips"),
)
def trips_in_month(tb):
    return month_trips(tb).select(*DRIVER_KEYS, "start_ts", "end_ts", *TRIP_MEASURES, LATE_DRIVE)


_NULLS = [*MEASURES, "late_drive"]


@query(
    "driver_null_counts",
    with_tables(f"""
select *, {" + ".join(f"{c}_nulls" for c in _NULLS)} as total_nulls
from (select {DRIVER},
        {", ".join(f"count(*) - count({c}) as {c}_nulls" for c in _NULLS)}
      from cohort_trips group by {DRIVER})
where {" + ".join(f"{c}_nulls" for c in _NULLS)} > 0"""),
)
def driver_null_counts(tb):
    trips = trips_of_month(tb.trips(), REWARD_MONTH)
    per_user = null_counts(trips, ["sentiance_id"], [*TRIP_MEASURES, LATE_DRIVE])
    return cohort(tb).select(*DRIVER_KEYS).join(per_user, "sentiance_id")


@query("trips_imputed", select(f"{DRIVER}, {TRIP_VALUES}", "imputed"))
def trips_imputed(tb):
    return fill_gaps(stored_cohort(tb), trips_of_month(tb.trips(), REWARD_MONTH))


@query("monthly_features", select(FEATURES, "features"))
def monthly_features(tb):
    return features(tb).select(
        *DRIVER_KEYS, "avg_hard_accel", "avg_hard_brake", "avg_legal", "avg_overall_score",
        "any_late_drive", "total_distance", "total_trip_duration",
        "total_late_drive_duration", "trip_count", "late_drive_ratio",
    )


_PROFILED = ["avg_hard_accel", "avg_hard_brake", "avg_legal", "avg_overall_score"]


@query(
    "feature_profile",
    with_tables(
        " union all ".join(
            f"select '{c}' as feature, count({c}) as value_count, "
            f"round(min({c}) + 1e-8, 6) as min_value, round(max({c}) + 1e-8, 6) as max_value from features"
            for c in _PROFILED
        )
    ),
)
def feature_profile(tb):
    return profile(features(tb), _PROFILED)


# ---- score --------------------------------------------------------------------


@query(
    "score_weights",
    select("r:avg_hard_accel, r:avg_hard_brake, r:avg_legal, r:avg_overall_score, r:late_drive_ratio", "weights"),
)
def score_weights(tb):
    return separation_weights(freeze(features(tb), "features"))


@query("driving_score", select(SCORED, "scored"))
def driving_scores(tb):
    return scored(tb).select(
        *DRIVER_KEYS, "avg_hard_accel", "avg_hard_brake", "avg_legal", "avg_overall_score",
        "any_late_drive", "total_distance", "total_trip_duration",
        "total_late_drive_duration", "trip_count", "late_drive_ratio", "driving_score",
    )


@query(
    "score_summary",
    with_tables("""
select round(min(driving_score) + 1e-8, 6) as min_score, round(avg(driving_score) + 1e-8, 6) as mean_score,
       round(max(driving_score) + 1e-8, 6) as max_score,
       round((select min(v) from (select driving_score as v,
                count(*) over (order by driving_score) as k, count(*) over () as n from scored)
              where k >= 0.5::double * n) + 1e-8, 6) as median_score,
       round((select driving_score from (select driving_score, count(*) as n from scored
                group by driving_score order by n desc, driving_score limit 1)) + 1e-8, 6) as mode_score
from scored"""),
)
def summary_of_scores(tb):
    return score_summary(scored(tb))


@query(
    "monthly_premium",
    with_tables(f"""
select {DRIVER}, s.trip_count, round(s.driving_score + 1e-8, 6) as driving_score,
       round(cast(p.premium_collected as double) + 1e-8, 6) as premium_collected
from scored s left join (
  select policy_number, item_no, imei_number,
         min_by(premium_collected, struct_pack(m := effective_year_month, p := premium_collected))
           as premium_collected
  from all_months_users where premium_collected is not null group by all) p
using (policy_number, item_no, imei_number)"""),
)
def monthly_premium(tb):
    all_months = with_device_user(from_month(tb.exposure(), REWARD_MONTH), tb.user_imei())
    joined = with_premium(scored(tb), all_months, ["effective_year_month"])
    return joined.select(*DRIVER_KEYS, "trip_count", "driving_score", "premium_collected")


@query(
    "missing_scores",
    with_tables(f"""
select {DRIVER}, d.driving_score from cohort c
left join (select {DRIVER}, driving_score from scored) d using ({DRIVER})
where d.driving_score is null"""),
)
def missing_scores(tb):
    everyone = scored_clients(cohort(tb), tb.trips(), REWARD_MONTH)
    return without_score(everyone).select(*DRIVER_KEYS, "driving_score")


# ---- groups and cashback ------------------------------------------------------


@query("score_sample", select("stable_key, r:unit_hash, r:driving_score", "score_sample"))
def sample_of_scores(tb):
    return score_sample(scored(tb), "md5")


@query(
    "global_dense_rank",
    with_tables("""
select stable_key, round(driving_score + 1e-8, 6) as driving_score,
       dense_rank() over (order by stable_key, driving_score nulls last) as row_id
from (select sc.driving_score, coalesce(c.policy_number, '') || '||' || coalesce(c.item_no, '')
        || '||' || coalesce(c.imei_number, '') || '||' || coalesce(c.sentiance_id, '')
          as stable_key
      from cohort c left join scored sc
        using (sentiance_id, policy_number, item_no, imei_number))"""),
)
def dense_rank_of_clients(tb):
    everyone = scored_clients(cohort(tb), tb.trips(), REWARD_MONTH)
    keyed = with_stable_key(everyone).select("stable_key", "driving_score")
    return global_dense_rank(keyed, ["stable_key", "driving_score"])


@query(
    "score_bandwidth",
    with_tables(
        "select '202401' as reward_month, round(bandwidth + 1e-8, 6) as bandwidth "
        "from fit_bandwidth"
    ),
)
def score_bandwidth(tb):
    fitted = score_centers(scored(tb), REWARD_MONTH)
    return fitted.select("reward_month", "bandwidth").distinct()


@query(
    "score_centers",
    with_tables("""
select '202401' as reward_month, round(bandwidth + 1e-8, 6) as bandwidth, ms_cluster,
       round(ms_center + 1e-8, 6) as ms_center
from fit_centers cross join fit_bandwidth"""),
)
def centers_of_scores(tb):
    return score_centers(scored(tb), REWARD_MONTH)


@query("nearest_center", select(f"{DRIVER}, r:driving_score, {NEAREST}", "nearest"))
def nearest_centers(tb):
    return nearest(tb).select(
        *DRIVER_KEYS, "driving_score", "bandwidth", "nearest_ms_cluster",
        "nearest_ms_center", "ms_center_gap",
    )


@query(
    "cluster_ranges",
    with_tables(f"""
select {DRIVER}, nearest_ms_cluster, round(driving_score + 1e-8, 6) as driving_score,
       round(min(driving_score) over g + 1e-8, 6) as min_ms_center,
       round(max(driving_score) over g + 1e-8, 6) as max_ms_center,
       count(*) over g as no_drivers_per_group
from nearest window g as (partition by nearest_ms_center)"""),
)
def cluster_ranges(tb):
    near = nearest(tb)
    return with_group_values(near, score_groups(near)).select(
        *DRIVER_KEYS, "nearest_ms_cluster", "driving_score", "min_ms_center",
        "max_ms_center", "no_drivers_per_group",
    )


@query(
    "cashback_ladder",
    select(f"nearest_ms_cluster, r:nearest_ms_center, {RANGES}, center_key, r:cashback_percent", "ladder"),
)
def ladder_of_groups(tb):
    return cashback_ladder(score_groups(nearest(tb)))


@query("cashback_borderline", select("r:earning_borderline_driving_score", "borderline"))
def cashback_borderline(tb):
    return earning_borderline(cashback_ladder(score_groups(nearest(tb))))


@query(
    "cashback_amount",
    select(
        f"{DRIVER}, r:driving_score, {RANGES}, r:premium_collected, r:cashback_percent, "
        "r:cashback_amount, r:earning_borderline_driving_score",
        "amounts",
    ),
)
def cashback_amounts(tb):
    return amounts(tb).select(
        *DRIVER_KEYS, "driving_score", "min_ms_center", "max_ms_center",
        "no_drivers_per_group", "premium_collected", "cashback_percent", "cashback_amount",
        "earning_borderline_driving_score",
    )


@query(
    "cashback_scaling",
    select("r:total_premium, r:total_cashback, r:cashback_share, r:scaling_factor", "factor"),
)
def cashback_scaling(tb):
    return scaling_factor(amounts(tb))


# ---- clients with and without trips -------------------------------------------


@query("clients_all", select(CLIENTS, "clients"))
def clients_with_results(tb):
    return clients(tb)


_TOTALS = """
  select sum(cast(premium_collected as decimal(28,8))) as p,
         sum(cast(cashback_amount as decimal(28,8))) as c,
         sum(cast(scaled_cashback_amount as decimal(28,8))) as s
  from clients where trip_count is not null"""


@query(
    "cashback_totals",
    with_tables(f"""
select round(cast(p as double) + 1e-8, 6) as total_premiums,
       round(cast(c as double) + 1e-8, 6) as total_cashback_paid,
       round(cast(s as double) + 1e-8, 6) as total_scaled_cashback_paid,
       round(cast(c as double) * 100 / cast(p as double) + 1e-8, 6) as cashback_pct,
       round(cast(s as double) * 100 / cast(p as double) + 1e-8, 6) as scaled_cashback_pct
from ({_TOTALS})"""),
)
def totals_of_cashback(tb):
    return cashback_totals(clients(tb))


@query(
    "cashback_distribution",
    with_tables("""
select round(cashback_percent + 1e-8, 6) as cashback_percent, count(*) as num_clients
from clients group by cashback_percent"""),
)
def distribution_of_cashback(tb):
    return cashback_distribution(clients(tb))


@query("no_trip_classes", select(RESULTS, "no_trips"))
def no_trip_classes(tb):
    return no_trips(tb)


@query(
    "no_trip_coverage",
    with_tables("""
select distinct sentiance_id from clients where no_trip_flag = 1
  and sentiance_id not in (select sentiance_id from no_trips where cashback_percent > 0)"""),
)
def no_trip_coverage(tb):
    everyone = clients(tb)
    without_trips = everyone.filter(F.col("no_trip_flag") == 1)
    rewarded = no_trip_rewards(everyone, tb.trips(), REWARD_MONTH).filter(
        F.col("cashback_percent") > 0
    )
    return not_covered(without_trips, rewarded, "sentiance_id")


@query(
    "no_trip_summary",
    with_tables("""
select reward_category, count(*) as client_count,
       round(cast(sum(cast(premium_collected as decimal(28,8))) as double) + 1e-8, 6) as total_premiums,
       round(cast(sum(cast(cashback_amount as decimal(28,8))) as double) + 1e-8, 6)
         as total_cashback_paid,
       round(cast(sum(cast(cashback_amount as decimal(28,8))) as double) * 100
         / cast(sum(cast(premium_collected as decimal(28,8))) as double), 2)
         as cashback_percent_of_premium
from no_trips group by reward_category"""),
)
def summary_of_no_trips(tb):
    return no_trip_summary(no_trips(tb))


@query(
    "month_totals",
    with_tables(f"""
select round(np + 1e-8, 6) as no_trip_premium, round(nc + 1e-8, 6) as no_trip_paid,
       round(nc * 100 / np, 2) as no_trip_pct, round(tp + np + 1e-8, 6) as month_premium,
       round(ts + nc + 1e-8, 6) as month_paid, round((ts + nc) * 100 / (tp + np) + 1e-8, 6) as month_pct
from (select cast(p as double) as tp, cast(s as double) as ts from ({_TOTALS})),
     (select cast(sum(cast(premium_collected as decimal(28,8))) as double) as np,
             cast(sum(cast(cashback_amount as decimal(28,8))) as double) as nc from no_trips)"""),
)
def totals_of_month(tb):
    everyone = clients(tb)
    return month_totals(everyone, no_trip_rewards(everyone, tb.trips(), REWARD_MONTH))


@query("rewards_union", select(RESULTS, "union_results"))
def rewards_union(tb):
    return results(tb)


# ---- payout -------------------------------------------------------------------


@query("rewards_enriched", select(ENRICHED, "enriched"))
def rewards_enriched(tb):
    return enriched(tb)


@query(
    "payout_threshold",
    select(f"{DRIVER}, reward_category, r:scaled_cashback_amount, r:cycle_reward_thresh", "paid"),
)
def payout_threshold(tb):
    return paid(tb).select(
        *DRIVER_KEYS, "reward_category", "scaled_cashback_amount", "cycle_reward_thresh"
    )


@query(
    "payout_buckets",
    with_tables("""
select case when cycle_reward_thresh > 0 then 'Earn > 0'
            when coalesce(premium_collected, 0) <= 0 then 'Zero — no premium_collected'
            else 'Zero — model 0%' end as payout_bucket,
       count(*) as num_clients, cast(min(premium_collected) as double) as min_premium_collected,
       cast(max(premium_collected) as double) as max_premium_collected,
       cast(min(cycle_reward_thresh) as double) as min_cycle_reward_thresh,
       cast(max(cycle_reward_thresh) as double) as max_cycle_reward_thresh
from paid group by 1"""),
)
def buckets_of_payout(tb):
    return payout_buckets(paid(tb))


@query(
    "zero_reasons",
    with_tables("""
select case when coalesce(premium_collected, 0) <= 0 then 'Zero due to no premium_collected'
            else 'Zero due to model 0%' end as reason, count(*) as num_clients
from paid where cycle_reward_thresh <= 0 group by 1"""),
)
def reasons_for_zero(tb):
    return zero_reasons(paid(tb))


@query(
    "premium_totals",
    with_tables("""
select round(cast(sum(premium_charged) as double) + 1e-8, 6) as total_premium_charged,
       round(cast(sum(premium_collected) as double) + 1e-8, 6) as total_premium_collected,
       cast(min(premium_collected) as double) as min_premium_collected,
       count(*) filter (where premium_collected < 0) as negative_premiums,
       count(*) filter (where premium_collected = 0) as zero_premiums
from paid"""),
)
def totals_of_premium(tb):
    return premium_totals(paid(tb))


@query(
    "premium_split",
    with_tables(f"""
select {DRIVER}, round(cast(premium_collected as double) + 1e-8, 6) as premium_collected,
       case when premium_collected > 1.84 then 'above' else 'up to' end as side
from paid where premium_collected is not null"""),
)
def premium_split(tb):
    everyone = paid(tb)
    above = above_premium_floor(everyone).withColumn("side", F.lit("above"))
    below = up_to_premium_floor(everyone).withColumn("side", F.lit("up to"))
    return above.unionByName(below).select(*DRIVER_KEYS, "premium_collected", "side")


@query(
    "cycle_dates",
    with_tables("""
select effective_year_month, strftime(s, '%Y-%m-%d') as month_start,
       strftime(s - interval 1 month, '%Y-%m-%d') as previous_month_start,
       strftime(s + interval 1 month, '%Y-%m-%d') as next_month_start,
       strftime(last_day(s), '%Y-%m-%d') as month_end,
       strftime(s, '%Y-%m-%d') as cycle_start_date,
       strftime(last_day(s) - interval 3 day, '%Y-%m-%d') as cycle_end_date,
       strftime(last_day(s + interval 3 month), '%Y-%m-%d') as cycle_maturation_date
from (select distinct effective_year_month, strptime(effective_year_month || '01', '%Y%m%d') as s
      from mi)"""),
)
def cycle_dates(tb):
    month = F.col("effective_year_month")
    months = tb.mi_exposure().select(F.col("EffectiveYearMonth").alias("effective_year_month"))
    return months.distinct().select(
        month,
        month_start(month).alias("month_start"),
        month_start(month, -1).alias("previous_month_start"),
        month_start(month, 1).alias("next_month_start"),
        month_end(month).alias("month_end"),
        cycle_start(month).alias("cycle_start_date"),
        cycle_end(month).alias("cycle_end_date"),
        cycle_maturation(month).alias("cycle_maturation_date"),
    )


@query(
    "cycle_number",
    with_tables("""
select distinct strftime(l_shipdate, '%Y-%m-%d') as cycle_end_date,
       cast((year(l_shipdate) - 2025) * 12 + month(l_shipdate) - 8 + 80 as integer)
         as cycle_number
from lineitem"""),
)
def cycle_numbers(tb):
    ends = tb.table("lineitem").select(F.col("l_shipdate").cast("date").alias("cycle_end_date"))
    return ends.distinct().withColumn("cycle_number", cycle_number(F.col("cycle_end_date")))


_REWARDS = "(select * from dated where premium_collected > 1.84)"


@query("rewards_full", select(REWARDS, _REWARDS))
def rewards_full(tb):
    return rewards(tb)


@query("rewards_fitted", select(REWARDS, _REWARDS, **FITTED))
def rewards_fitted(tb):
    return build_rewards(cohort(tb), tb.trips(), REWARD_MONTH, run_ts())


@query("rewards_target_schema", select(REWARDS, _REWARDS))
def rewards_target_schema(tb):
    """The declared table, empty, then filled with the rows of the month."""
    path = fresh_path(tb.spark, "rewards")
    empty_table(tb.spark, REWARDS_SCHEMA).write.parquet(path)
    rewards(tb).write.mode("append").parquet(path)
    return tb.spark.read.schema(REWARDS_SCHEMA).parquet(path)


@query(
    "sink_insert_only_merge",
    select(
        REWARDS + ", loaded",
        f"""(
select *, case when reward_category = 'Had Trips' then '2024-02-01' else '2024-02-03' end as loaded
from {_REWARDS}
union all
select * replace (cycle_number - 1 as cycle_number), '2024-01-01' as loaded from {_REWARDS})""",
    ),
)
def sink_insert_only_merge(tb):
    """Clients with trips are in the table already, and all of an earlier cycle; the
    merge adds the others."""
    path = fresh_path(tb.spark, "merged")
    current = freeze(rewards(tb), "current")
    stored = current.filter(F.col("reward_category") == "Had Trips")
    earlier = current.withColumn("cycle_number", F.col("cycle_number") - 1)
    both = stored.withColumn("loaded", F.lit("2024-02-01")).union(
        earlier.withColumn("loaded", F.lit("2024-01-01"))
    )
    both.write.partitionBy("cycle_number").parquet(path)
    source = current.withColumn("loaded", F.lit("2024-02-03"))
    insert_only_merge(source, path, REWARD_KEYS, partition_by="cycle_number")
    return tb.spark.read.schema(source.schema).parquet(path)
