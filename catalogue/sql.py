"""The same tables and rules as SQL.

``TABLES`` names every intermediate table with its query; ``select`` puts the
ones a query needs, directly or through others, into a WITH clause.
"""

from __future__ import annotations

import re

RUN_TS = "timestamp '2024-02-03 06:00:00'"

DRIVER = "sentiance_id, policy_number, item_no, imei_number"
MEASURES = [
    "hard_accel", "hard_brake", "legal", "overall_score",
    "distance", "trip_duration", "late_drive_duration",
]
COMPONENTS = {
    "avg_hard_accel": "bad",
    "avg_hard_brake": "bad",
    "avg_legal": "good",
    "avg_overall_score": "good",
    "late_drive_ratio": "bad",
}

TABLES: dict[str, str] = {}

TABLES["lines"] = """
select l.*, o.o_orderdate, o.o_orderstatus, o.o_orderpriority, o.o_custkey,
       cast(o_custkey as varchar) as policy,
       o_custkey || '-' || (l_partkey % 3) as asset,
       case when o_custkey % 8 = 5 then 'x' || o_custkey
            else cast(o_custkey // 10 as varchar) end as imei
from lineitem l join orders o on l.l_orderkey = o.o_orderkey"""

TABLES["mi"] = """
select 'core' as source_data,
       substr(c_mktsegment, 1, 3) || '-' || policy
         || case when l_orderkey % 97 = 0 then '' else '/' || l_linenumber end as policy_no,
       policy as policy_number,
       o_orderdate as policy_inception_date, l_shipdate as item_inception_date,
       case when o_orderstatus = 'F' then l_shipdate end as cancelled_date,
       o_orderdate as eff_from_date, l_shipdate as eff_to_date,
       o_orderpriority as section_code, p_type as cover_code,
       p_name as item_description, p_brand as veh_make, p_type as veh_model,
       'REG' || l_partkey as registration,
       'VIN' || l_partkey || '-' || l_suppkey as vin_number,
       imei as imei_number,
       cast(l_extendedprice as decimal(18,2)) as cover_premium,
       p_retailprice as cover_sum_insured, cast(p_size as varchar) as cover_description,
       case when l_linenumber in (4, 5) and l_linestatus = 'F' then ' Policy '
            when l_linenumber = 3 and l_linestatus = 'O' then 'Cancelled'
            else 'Policy' end as policy_status,
       policy_status as cover_status,
       asset as lob_asset_id, 'raw-' || l_partkey as item_no_raw,
       l_returnflag as policy_cancellation_reason_code,
       l_shipdate as end_date, o_orderdate as effective_from_date,
       l_shipdate as effective_to_date,
       case l_suppkey % 4 when 0 then '202311' when 1 then '202312'
            when 2 then '202401' else '202402' end as effective_year_month,
       cast(substr(effective_year_month, 1, 4) as integer) as effective_year,
       case substr(effective_year_month, 5, 2) when '11' then 4 when '12' then 4
            else 1 end as effective_quarter,
       cast(substr(effective_year_month, 5, 2) as integer) as effective_month,
       effective_year || 'Q' || effective_quarter as effective_year_quarter,
       case l_linenumber when 6 then timestamp '2024-03-15'
            when 7 then timestamp '2024-06-30' end as item_cancelled_date,
       cast(case when l_orderkey % 89 = 0 then null
            when l_orderkey % 101 = 0 then -5
            when l_returnflag = 'N' and l_linenumber in (1, 7) then 0
            else 10 * l_quantity end as decimal(18,2)) as premium_collected,
       asset as active_lob_asset_id
from lines join customer on o_custkey = c_custkey join part on l_partkey = p_partkey"""

TABLES["featured"] = """
select *, replace(policy_no, '-', '') as cleaned_policy_no,
       regexp_extract(replace(policy_no, '-', ''), '^([A-Za-z]+)', 1)
         as policy_product_description,
       try_cast(split(policy_no, '/')[2] as integer) as policy_version_number
from mi"""

TABLES["mi_latest"] = """
select * from featured
qualify row_number() over (
  partition by policy_number, lob_asset_id, effective_year_month
  order by policy_version_number desc nulls last, cover_premium desc nulls last,
           premium_collected desc nulls last, cover_sum_insured desc nulls last,
           item_cancelled_date desc nulls last, policy_status desc nulls last,
           cover_status desc nulls last, item_inception_date desc nulls last,
           policy_inception_date desc nulls last, item_no_raw desc nulls last,
           vin_number desc nulls last) = 1"""

TABLES["devices"] = """
select policy as policy_number, asset as item_no, l_shipdate as inserted_datetime,
       imei as imei_number,
       case when l_linenumber <> 1
            then timestamp '2024-01-01' + to_days(cast(l_orderkey % 30 as integer)) end
         as installation_datetime,
       l_orderkey * 10 + l_linenumber as row_id
from lines"""

TABLES["devices_latest"] = """
select policy_number, item_no, inserted_datetime, imei_number, installation_datetime
from devices
qualify row_number() over (
  partition by policy_number, item_no
  order by inserted_datetime desc nulls last, row_id desc nulls last,
           installation_datetime desc nulls last, imei_number desc nulls last) = 1"""

TABLES["user_imei"] = """
select cast(user_id as varchar) as imei_number, ts as retrieved_datetime,
       's' || user_id as sentiance_id
from events"""

TABLES["first_seen"] = """
select imei_number, min(retrieved_datetime) as imei_first_detection_datetime
from user_imei group by imei_number"""

TABLES["corrected"] = """
select d.*, imei_first_detection_datetime,
       case when installation_datetime is null then imei_first_detection_datetime
            when imei_first_detection_datetime < installation_datetime
            then imei_first_detection_datetime
            else installation_datetime end as installation_datetime_final
from devices_latest d left join first_seen using (imei_number)"""

TABLES["mapping"] = f"""
select m.source_data, m.policy_version_number, m.policy_product_description,
       m.policy_number, m.lob_asset_id as item_no, m.cover_premium as premium,
       m.premium_collected, m.cover_sum_insured, m.active_lob_asset_id,
       m.item_no_raw as original_lob_asset_id, m.vin_number, m.imei_number,
       m.veh_make as make, m.veh_model as model, m.registration as registration_number,
       m.section_code, m.cover_code, m.item_description, m.cover_description,
       m.policy_status, m.cover_status, m.policy_cancellation_reason_code,
       m.item_inception_date as item_inception_datetime, m.policy_inception_date,
       m.item_cancelled_date as item_cancellation_date,
       m.cancelled_date as policy_cancellation_date,
       t.imei_first_detection_datetime,
       t.installation_datetime_final as installation_datetime,
       m.effective_year_month, m.effective_from_date, m.effective_to_date,
       {RUN_TS} as inserted_timestamp
from corrected t right join mi_latest m on t.item_no = m.lob_asset_id"""

TABLES["exposure_from"] = f"""
select * exclude (inserted_timestamp),
       {RUN_TS} + to_days(case
         when cast(policy_number as integer) % 3 = 0 and effective_year_month = '202402' then -9
         else cast(substr(effective_year_month, 5) as integer) % 3 end) as inserted_timestamp
from mapping where effective_year_month >= '202401'"""

TABLES["exposure_latest"] = """
select * from exposure_from
qualify row_number() over (
  partition by policy_number, item_no
  order by inserted_timestamp desc, effective_year_month desc, premium desc nulls last,
           premium_collected desc nulls last, imei_number desc nulls last,
           original_lob_asset_id desc nulls last,
           item_cancellation_date desc nulls last) = 1"""

TABLES["users"] = "select distinct imei_number, sentiance_id from user_imei"

TABLES["exposure_users"] = """
select e.*, u.sentiance_id from exposure_latest e join users u using (imei_number)"""

TABLES["all_months_users"] = """
select e.*, u.sentiance_id from exposure_from e join users u using (imei_number)"""


def _cancel_date(source: str) -> str:
    """Per device, policy and item the earliest month's row, its cancellation the least of all."""
    return f"""
select * exclude (item_cancellation_date),
       min(item_cancellation_date) over (partition by imei_number, policy_number, item_no)
         as item_cancellation_date
from {source}
qualify row_number() over (
  partition by imei_number, policy_number, item_no
  order by cast(effective_year_month as integer) nulls first, sentiance_id nulls first,
           premium nulls first, original_lob_asset_id nulls first) = 1"""


TABLES["chosen"] = _cancel_date("exposure_users")
TABLES["chosen_of_all_months"] = _cancel_date("all_months_users")

TABLES["cohort"] = """
select *, cast(item_cancellation_date as date) as item_cancellation_date_cast,
       last_day(date '2024-01-31' + interval 3 month) as maturation_date
from chosen
where trim(policy_status) = 'Policy' and trim(cover_status) = 'Policy'
  and (item_cancellation_date is null
       or last_day(date '2024-01-31' + interval 3 month)
            <= cast(item_cancellation_date as date))"""

TABLES["trips"] = """
with moved as (
  select *, ts + to_months(case user_id % 10 when 0 then -1 when 1 then -3 when 2 then 1
                           else 0 end) as start,
         user_id % 5 as skill
  from events),
timed as (
  select *, start + to_minutes(cast(floor(value) as integer)
              + case when event_id % 40 = 0 then 21600 else 0 end) as finish,
         case when hour(start) >= 23 or hour(start) < 4 then 1 else 0 end as late
  from moved)
select 's' || user_id as sentiance_id,
       strftime(start, '%Y-%m-%d %H:%M:%S') as start_ts,
       strftime(finish, '%Y-%m-%d %H:%M:%S') as end_ts,
       case when event_id % 13 <> 0 and user_id <> 7
         then (event_id * 37 % 101 * 6 + (4 - skill) * 100) / 1000.0::double end as hard_accel,
       case when event_id % 13 <> 1 and user_id <> 7
         then (event_id * 53 % 101 * 6 + (4 - skill) * 100) / 1000.0::double end as hard_brake,
       case when event_id % 13 <> 2 and user_id <> 7
         then (event_id * 71 % 101 * 6 + skill * 100) / 1000.0::double end as legal,
       case when event_id % 13 <> 3 and user_id <> 7
         then (event_id * 29 % 101 * 6 + skill * 100) / 1000.0::double end as overall_score,
       case when event_id % 13 <> 4 and user_id <> 7 then value end as distance,
       case when event_id % 13 <> 5 and user_id <> 7 then value * 60 end as trip_duration,
       case when event_id % 13 <> 6 and user_id <> 7 then late * value * 30 end
         as late_drive_duration,
       case when event_id % 13 <> 7 and user_id <> 7 then late end as late_drive
from timed"""

TABLES["month_trips"] = """
select *, cast(start_ts as timestamp) as start_ts_parsed,
       cast(end_ts as timestamp) as end_ts_parsed
from trips
where year(cast(start_ts as timestamp)) = 2024 and month(cast(start_ts as timestamp)) = 1
  and year(cast(end_ts as timestamp)) = 2024 and month(cast(end_ts as timestamp)) = 1"""

TABLES["cohort_trips"] = """
select c.policy_number, c.item_no, c.imei_number, t.*
from cohort c join month_trips t using (sentiance_id)"""

TABLES["imputed"] = f"""
with means as (
  select {DRIVER}, {", ".join(f"avg({c}) as {c}_mean" for c in MEASURES)}
  from cohort_trips group by all),
overall as (select {", ".join(f"avg({c}) as {c}_all" for c in MEASURES)} from cohort_trips)
select t.sentiance_id, t.policy_number, t.item_no, t.imei_number,
       {", ".join(f"coalesce(t.{c}, m.{c}_mean, o.{c}_all, 0.0) as {c}" for c in MEASURES)},
       case when t.late_drive is null then 1 else t.late_drive end as late_drive
from cohort_trips t
join means m using ({DRIVER}) cross join overall o"""

TABLES["features"] = f"""
with rolled as (
  select {DRIVER}, round(avg(hard_accel), 10) as avg_hard_accel,
         round(avg(hard_brake), 10) as avg_hard_brake, round(avg(legal), 10) as avg_legal,
         round(avg(overall_score), 10) as avg_overall_score,
         max(late_drive) as any_late_drive, sum(distance) as total_distance,
         sum(trip_duration) as total_trip_duration,
         sum(late_drive_duration) as total_late_drive_duration, count(*) as trip_count
  from imputed group by all)
select *, round(greatest(0.0, least(1.0,
         total_late_drive_duration / (total_trip_duration + 1e-9))), 10) as late_drive_ratio
from rolled"""


def _fifth(column: str, share: float, test: str) -> str:
    """Mean of the rows of a column on one side of its quantile."""
    return f"""(select avg({column}) from features where {column} {test} (
      select min(v) from (select {column} as v, count(*) over (order by {column}) as k,
                                 count(*) over () as n from features)
      where k >= {share}::double * n))"""


def _raw_weight(column: str) -> str:
    gap = f"{_fifth(column, 0.8, '>=')} - {_fifth(column, 0.2, '<=')}"
    spread = f"(select coalesce(stddev_samp({column}), 0.0) from features)"
    return f"abs({gap}) / greatest({spread}, 1e-9) as {column}"


TABLES["weights"] = f"""
with raw as (select {", ".join(_raw_weight(c) for c in COMPONENTS)})
select {", ".join(f"{c} / ({' + '.join(COMPONENTS)}) as {c}" for c in COMPONENTS)} from raw"""

_TERMS = " + ".join(
    f"w.{c} * " + (f"(1.0 - f.{c})" if direction == "bad" else f"f.{c}")
    for c, direction in COMPONENTS.items()
)
TABLES["scored"] = f"""
select f.*, round({_TERMS}, 10) as driving_score from features f cross join weights w"""

TABLES["premiums"] = """
select policy_number, item_no, imei_number,
       min_by(premium_collected, (effective_year_month, premium_collected)) as premium_collected
from chosen_of_all_months where premium_collected is not null group by all"""

TABLES["monthly"] = """
select s.*, c.premium_collected
from scored s join cohort c using (sentiance_id, policy_number, item_no, imei_number)"""

TABLES["score_sample"] = """
with keyed as (
  select *, coalesce(policy_number, '') || '||' || coalesce(item_no, '') || '||'
            || coalesce(imei_number, '') || '||' || coalesce(sentiance_id, '') as stable_key
  from monthly),
hashed as (
  select *, cast(cast('0x' || substr(md5(stable_key), 1, 8) as bigint) as double)
              / 4294967296.0::double as unit_hash
  from keyed)
select stable_key, unit_hash, driving_score from hashed
where driving_score is not null and unit_hash < 0.2"""

TABLES["centers"] = """
select * from (values (0, 0.33::double), (1, 0.59::double), (2, 0.71::double))
  as c(ms_cluster, ms_center)"""

# the fit: cells of a histogram, neighbour distances by pairs of cells, mean shift by recursion
TABLES["fit_points"] = """
select round(sum(driving_score) / count(*), 8) as v, count(*) as n
from monthly where driving_score is not null group by floor(driving_score / 1e-4::double)"""

TABLES["fit_bandwidth"] = """
with all_of as (
  select greatest(1, cast(floor(sum(n) * 0.3::double) as bigint)) as k from fit_points),
far as (
  select a.v, a.n, abs(a.v - b.v) as gap,
         sum(b.n) over (partition by a.v order by abs(a.v - b.v)) as within
  from fit_points a join fit_points b on true),
reach as (select v, n, min(gap) as gap from far, all_of where within >= k group by v, n)
select round(greatest(sum(gap * n) / sum(n), 1e-3::double), 8) as bandwidth from reach"""

TABLES["fit_seeds"] = """
select distinct round_even(v / bandwidth, 0) * bandwidth as seed
from fit_points cross join fit_bandwidth"""

TABLES["fit_shift"] = """
select seed, seed as centre, 0 as step, 9.0::double as moved, 0 as inside from fit_seeds
union all
select s.seed, sum(v * n) / sum(n), s.step + 1, abs(sum(v * n) / sum(n) - s.centre), sum(n)
from fit_shift s cross join fit_bandwidth b join fit_points p on abs(v - centre) <= bandwidth
where s.step <= 300 and s.moved > 1e-3 * bandwidth
group by s.seed, s.centre, s.step"""

TABLES["fit_resting"] = """
select row_number() over (order by inside desc, centre desc) as place, centre
from (select * from fit_shift where step > 0
      qualify row_number() over (partition by seed order by step desc) = 1)"""

TABLES["fit_kept"] = """
select 0::bigint as place, []::double[] as kept
union all
select r.place, case when len(list_filter(k.kept, lambda x: abs(x - r.centre) <= bandwidth)) = 0
                     then list_append(k.kept, r.centre) else k.kept end
from fit_kept k join fit_resting r on r.place = k.place + 1 cross join fit_bandwidth"""

TABLES["fit_centers"] = """
select cast(row_number() over (order by c) - 1 as integer) as ms_cluster, c as ms_center
from (select unnest(kept) as c from (select kept from fit_kept order by place desc limit 1))"""

TABLES["nearest"] = f"""
select m.*, 0.07::double as bandwidth, ms_cluster as nearest_ms_cluster,
       ms_center as nearest_ms_center, abs(driving_score - ms_center) as ms_center_gap
from monthly m cross join centers
qualify row_number() over (
  partition by {DRIVER} order by abs(driving_score - ms_center), ms_center) = 1"""

TABLES["score_groups"] = """
select nearest_ms_cluster, nearest_ms_center, min(driving_score) as min_ms_center,
       max(driving_score) as max_ms_center, count(*) as no_drivers_per_group
from nearest group by all"""

TABLES["ladder"] = """
with ranked as (
  select *, min_ms_center >= 0.5 as paying,
         row_number() over (partition by min_ms_center >= 0.5
                            order by min_ms_center, nearest_ms_center) - 1 as i,
         count(*) over (partition by min_ms_center >= 0.5) as n
  from score_groups)
select * exclude (paying, i, n), printf('%.6f', nearest_ms_center) as center_key,
       case when not paying then 0.0::double when n = 1 then 0.3::double
            else 0.05::double + 0.25::double * (i::double / (n - 1)) end as cashback_percent
from ranked"""

TABLES["borderline"] = """
select coalesce(max_by(max_ms_center, nearest_ms_center), 0.5)
         as earning_borderline_driving_score
from ladder where cashback_percent = 0"""

TABLES["amounts"] = """
select n.*, l.min_ms_center, l.max_ms_center, l.no_drivers_per_group,
       coalesce(l.cashback_percent, 0.0) as cashback_percent,
       coalesce(l.cashback_percent, 0.0) * cast(n.premium_collected as double)
         as cashback_amount,
       b.earning_borderline_driving_score
from nearest n left join ladder l using (nearest_ms_cluster) cross join borderline b"""

TABLES["factor"] = """
with totals as (
  select cast(sum(cast(premium_collected as decimal(28,8))) as double) as total_premium,
         cast(sum(cast(cashback_amount as decimal(28,8))) as double) as total_cashback
  from amounts where trip_count is not null)
select *, total_cashback / nullif(total_premium, 0) as cashback_share,
       case when total_cashback / nullif(total_premium, 0) between 0.05 and 0.06 then 1.0::double
            when total_cashback > 0 and total_premium <> 0
              then total_premium * 0.05::double / total_cashback
            else 0.0::double end as scaling_factor
from totals"""

TABLES["scaled"] = """
select a.*, f.scaling_factor, a.cashback_amount * f.scaling_factor as scaled_cashback_amount
from amounts a cross join factor f where trip_count is not null"""

TABLES["clients"] = f"""
with everyone as (select distinct {DRIVER}, premium_collected from cohort)
select e.*, s.* exclude ({DRIVER}, premium_collected),
       case when s.trip_count is null then 1 else 0 end as no_trip_flag
from everyone e left join scaled s using ({DRIVER})"""

TABLES["no_trips"] = """
with past as (
  select sentiance_id, max(cast(start_ts as timestamp)) as last_start from trips
  where cast(start_ts as timestamp) < timestamp '2024-01-01' group by sentiance_id),
classes as (
  select c.*, case when last_start is null then 'Absolutely No Trip Ever'
                   when last_start >= timestamp '2023-12-01'
                     then 'Did Not Drive This Month (Device Working)'
                   else 'Had Trips Then Stopped' end as reward_category
  from clients c left join past using (sentiance_id) where no_trip_flag = 1),
percents as (
  select *, case when reward_category like 'Did Not%' then 0.4::double
                 when reward_category like 'Had%' then 0.05::double
                 else 0.0::double end as percent
  from classes)
select * exclude (cashback_percent, cashback_amount, percent),
       percent as cashback_percent,
       cast(premium_collected as double) * percent as cashback_amount
from percents"""

TABLES["union_results"] = """
select *, 'Had Trips' as reward_category from clients where trip_count is not null
union all by name
select * exclude (scaled_cashback_amount), cashback_amount as scaled_cashback_amount
from no_trips"""

TABLES["enriched"] = """
select u.* exclude (premium_collected), round(u.premium_collected, 2) as premium_collected,
       c.premium as premium_charged, c.item_description, c.original_lob_asset_id
from union_results u left join cohort c using (policy_number, item_no, imei_number)"""

TABLES["paid"] = """
select *, case when round(scaled_cashback_amount) < 10 then 0.0
               when round(scaled_cashback_amount) >= 10
                    and round(scaled_cashback_amount) < 20 then 20.0
               else round(scaled_cashback_amount) end as cycle_reward_thresh
from enriched"""

TABLES["dated"] = f"""
select *, date '2024-01-01' as cycle_start_date, date '2024-01-28' as cycle_end_date,
       date '2024-04-30' as cycle_maturation_date, {RUN_TS} as calculated_datetime,
       2024 * 12 + 1 - (2025 * 12 + 8) + 80 as cycle_number
from paid"""

TABLES["addresses"] = """
select c_custkey as id,
       case when c_custkey % 50 = 0 then '' else c_name || ', ' || n_name end as address
from customer join nation on c_nationkey = n_nationkey
union all
select c_custkey, '' from customer where c_custkey % 25 = 3
union all
select c_custkey, c_name || ', ' || n_name || ' (old)'
from customer join nation on c_nationkey = n_nationkey where c_custkey % 25 = 7"""

TABLES["requests"] = """
select * from (values
  (0, 1, 0, 200), (1, 1, 0, 200), (2, 1, 0, 200), (3, 1, 0, 429), (3, 2, 0, 200),
  (4, 1, 0, 400), (4, 1, 1, 400), (4, 1, 2, 200), (5, 1, 0, 503), (5, 2, 0, 503),
  (5, 3, 0, 503), (6, 1, 0, 429), (6, 2, 0, 429), (6, 3, 0, 429), (7, 1, 0, 503),
  (7, 2, 0, 200), (8, 1, 0, 400), (8, 1, 1, 400), (8, 1, 2, 400), (8, 2, 0, 503),
  (8, 3, 0, 400), (8, 3, 1, 200), (9, 1, 0, null), (9, 2, 0, null), (9, 3, 0, null),
  (10, 1, 0, 503), (10, 2, 0, null), (10, 3, 0, 200), (11, 1, 0, 400), (11, 1, 1, 400),
  (11, 1, 2, 400), (11, 2, 0, 400), (11, 2, 1, 400), (11, 2, 2, 400), (11, 3, 0, 400),
  (11, 3, 1, 400), (11, 3, 2, 400)) as t(kind, retry, step, status)"""

TABLES["attempts"] = """
select id, address, retry, step, status,
       case status when 200 then 'OK' when 400 then 'Bad Request' when 429 then 'Too Many Requests'
            when 503 then 'Service Unavailable' else 'Connection refused' end as reason,
       coalesce(status = 200 and retry = 1 and id % 5 = 4, false) as garbled
from addresses join requests on kind = id % 12 where address <> ''
union all
select id, address, 9, 0, 200, 'OK', false
from addresses where address <> '' and id % 10 = 9"""

TABLES["resolved"] = """
select distinct cast(a.id as varchar) as id, a.address as "inputAddress", a.id as key,
       case when a.address = '' then 'empty address'
            when a.id % 12 in (0, 1, 2, 4) and a.id % 10 = 4
              then 'unreadable answer: ' || case when a.id % 4 = 0 then '{"results":[{"type":"Poi'
                                                 else '<html>busy</html>' end
            when a.id % 12 = 6 then 'rate limited'
            when a.id % 12 = 9 and a.id % 10 <> 9 then 'Connection refused'
            when a.id % 12 = 5 and a.id % 10 <> 9
              then '503 Service Unavailable: refused ' || a.id || ' ' || repeat('x', 320)
            when a.id % 12 = 11 and a.id % 10 <> 9
              then '400 Bad Request: refused ' || a.id || ' ' || repeat('x', 320)
            when a.id % 6 = 0 then 'no results' end as error
from addresses a"""

TABLES["candidates"] = """
with ranks as (
  select r.*, unnest(case when error is null then range(1, cast(key % 6 as bigint) + 1)
                          else [null] end) as rank
  from resolved r)
select id, "inputAddress", 10.5::double - rank as score, rank as "scoreRank",
       "inputAddress" || ' #' || rank as "freeformAddress",
       case when rank is not null then 'ZA' end as "countryCode",
       case when rank is not null then 'M' || (key % 40) end as municipality,
       'Street ' || rank as "streetName",
       case when rank is not null then cast(key % 9000 + 1000 as varchar) end as "postalCode",
       case when rank is not null then (key % 1000 - 3500) / 100.0::double end as lat,
       case when rank is not null then (key % 1300 + 1800) / 100.0::double end as lon,
       case when rank % 2 = 1 then 'Point Address' when rank % 2 = 0 then 'Street' end
         as "matchType",
       error
from ranks"""

TABLES["geocoded"] = f"""
select *, {RUN_TS} as geocoded_at from candidates
qualify row_number() over (partition by id order by "scoreRank" nulls last, "inputAddress") = 1"""

TABLES["items"] = """
select id, 'POINT(' || cast(lon as varchar) || ' ' || cast(lat as varchar) || ')'
         as wkt_geometry, 100 as buffer
from geocoded where lat is not null and lon is not null"""

# the same chain on fitted instead of given centres
FITTED = {
    "centers": "select * from fit_centers",
    "nearest": TABLES["nearest"].replace("0.07::double", "(select bandwidth from fit_bandwidth)"),
}

SCORE_NAMES = [
    "river_flood_score_defended", "river_flood_score_undefended",
    "surface_water_flood_score_undefended", "overall_flood_score_defended",
    "overall_flood_score_undefended", "floodability_defended", "floodability_undefended",
]
TABLES["flood_attempts"] = """
with batches as (select distinct c_custkey // 10 as batch_id from customer),
kinds as (
  select *, batch_id % 5 as kind, batch_id % 7 <> 6 as asked, count(*) over () as n,
         batch_id % 10 = 5 as garbled from batches)
select batch_id, asked and kind < 3 and not garbled as answered,
       case when not asked then null when kind = 0 then 1 when kind in (1, 4) then 2
            when kind = 2 then 3 else 4 end as deciding_retry,
       case when not asked or kind = 4 then null when kind = 3 then 500 else 200 end as status,
       case when asked and kind < 3 and not garbled then '[]' end as body,
       case when not asked then 'no attempt'
            when garbled then '[batch ' || batch_id || '/' || n || '] unreadable answer: [{"id":"7"},{'
            when kind = 3 then '[batch ' || batch_id || '/' || n || '] 500 Down: try later'
            when kind = 4 then '[batch ' || batch_id || '/' || n || '] Timed out' end as error
from kinds"""

TABLES["score_items"] = f"""
select cast(c_custkey as varchar) as address_id, c_custkey // 10 as batch_id,
       {", ".join(f"cast(c_custkey * {i + 3} % 100 as double) as {n}" for i, n in enumerate(SCORE_NAMES))},
       c_acctbal > 9000 as twice
from customer where c_acctbal >= 0"""


def _depth_columns() -> dict[str, str]:
    columns = {}
    for prefix, factor in (("river_flood", 1), ("surface_water_flood", 2)):
        for period in (20, 50, 100, 200, 500, 1500):
            depth = f"(c_custkey % 10) * {period * factor}"
            start = f"{prefix}_rp{period}"
            columns[f"{start}_affected_area_percentage"] = "c_custkey % 100"
            columns[f"{start}_min_depth_meters"] = f"{depth} / 100.0::double"
            columns[f"{start}_max_depth_meters"] = f"({depth} + 100) / 100.0::double"
            columns[f"{start}_mean_depth_meters"] = f"({depth} + 50) / 100.0::double"
            columns[f"{start}_std_dev_depth_meters"] = "0.25"
        if factor == 1:
            columns[f"{prefix}_standard_of_protection_rp"] = "c_custkey % 200"
    return columns


DEPTH_COLUMNS = _depth_columns()
TABLES["depth_items"] = f"""
select cast(c_custkey as varchar) as address_id, c_custkey // 10 as batch_id,
       {", ".join(f"cast({e} as double) as {n}" for n, e in DEPTH_COLUMNS.items())},
       c_acctbal > 9000 as twice
from customer where not (c_mktsegment = 'MACHINERY' and c_acctbal < 4000)"""

TABLES["merged"] = """
select d.* exclude (batch_id, twice), s.* exclude (address_id, batch_id, twice)
from depth_items d join score_items s using (address_id)"""

TABLES["flood"] = f"""
select g.id as address_id, g.* exclude (id), m.* exclude (address_id),
       {RUN_TS} as risk_computed_at
from geocoded g join merged m on g.id = m.address_id
where g.lat is not null and g.lon is not null"""


RECURSIVE = ("fit_shift", "fit_kept")


def _needed(text: str, tables: dict[str, str], found: list[str], within: str = "") -> list[str]:
    for name, body in tables.items():
        if name != within and name not in found and re.search(rf"\b(from|join)\s+{name}\b", text):
            _needed(body, tables, found, name)
            found.append(name)
    return found


def with_tables(text: str, **replaced: str) -> str:
    """The query with the tables it needs; some of them may be replaced."""
    tables = TABLES | replaced
    names = _needed(text, tables, [])
    if not names:
        return text
    clauses = ",\n".join(
        f"{n} as {'' if n in RECURSIVE else 'materialized '}({tables[n].strip()})" for n in names
    )
    recursive = "recursive " if set(RECURSIVE) & set(names) else ""
    return f"with {recursive}{clauses}\n{text}"


FORMS = {
    "r": "round(cast({} as double) + 1e-8, 6)",
    "s": "cast({} as varchar)",
    "t": "strftime({}, '%Y-%m-%d %H:%M:%S.%f')",
    "d": "strftime({}, '%Y-%m-%d')",
    "i": "cast({} as bigint)",
}


def select(columns: str, source: str, **replaced: str) -> str:
    """SELECT with marked columns in the form the queries return them.

    r: rounded double, s: text, t: timestamp text, d: date text, i: integer.
    """
    parts = []
    for column in re.split(r",\s*", " ".join(columns.split())):
        mark, _, name = column.rpartition(":")
        name = f'"{name}"'
        parts.append(f"{FORMS[mark].format(name)} as {name}" if mark else name)
    return with_tables(f"select {', '.join(parts)} from {source}", **replaced)
