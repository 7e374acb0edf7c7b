"""Addresses, geocoder responses and flood responses."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.sql import DEPTH_COLUMNS, SCORE_NAMES, select, with_tables
from catalogue.testbed import Testbed, run_ts
from tarmac.operators.quality import require_columns
from tarmac.operators.responses import (
    batch_outcomes,
    best_candidates,
    enrich_partitions,
    fallback_parameters,
    final_outcomes,
    flat_depths,
    flat_scores,
    geocode_candidates,
    merge_depths_and_scores,
    request_batches,
    request_items,
    resolved_addresses,
    unreadable_responses,
)
from tarmac.plans.flood import build_flood_risk
from tarmac.plans.geocode import build_geocoded

GEOCODE = """id, inputAddress, r:score, scoreRank, freeformAddress, countryCode, municipality,
streetName, postalCode, r:lat, r:lon, matchType, error"""
DEPTHS = ", ".join(f"r:{c}" for c in DEPTH_COLUMNS)
SCORES = ", ".join(f"r:{c}" for c in SCORE_NAMES)
PARAMETERS = {
    "countrySet": "ZA",
    "minFuzzyLevel": "1",
    "maxFuzzyLevel": "2",
    "limit": "5",
    "view": "Unified",
    "language": "en-ZA",
    "idxSet": "Geo,Addr",
}


def resolved(tb: Testbed) -> DataFrame:
    return resolved_addresses(tb.addresses(), tb.geocode_log())


def geocoded(tb: Testbed) -> DataFrame:
    return build_geocoded(tb.addresses(), tb.geocode_log(), run_ts())


@query(
    "geo_attempts",
    with_tables("""
select cast(id as varchar) as id, address, retry as deciding_retry, step as deciding_step,
       status, reason, coalesce(status < 400, false) and not garbled as answered
from attempts
qualify row_number() over (
  partition by id, address
  order by coalesce(status < 400, false) and not garbled desc,
           case when status < 400 and not garbled then retry * 10 + step
                else -retry * 10 - step end) = 1"""),
)
def geo_attempts(tb):
    outcomes = final_outcomes(tb.geocode_log().withColumn("id", F.col("id").cast("string")))
    return outcomes.drop("body", "asked")


@query("geo_candidates", select(GEOCODE, "(select * from candidates where error is null)"))
def geo_candidates(tb):
    return geocode_candidates(resolved(tb)).filter(F.col("error").isNull())


@query("geo_error_rows", select(GEOCODE, "(select * from candidates where error is not null)"))
def geo_error_rows(tb):
    return geocode_candidates(resolved(tb)).filter(F.col("error").isNotNull())


@query("geo_top1", select(GEOCODE, "geocoded"))
def geo_top1(tb):
    addresses = require_columns(tb.addresses(), ["id", "address"], "address_source")
    return best_candidates(geocode_candidates(resolved_addresses(addresses, tb.geocode_log())))


@query("geo_full", select(GEOCODE + ", t:geocoded_at", "geocoded"))
def geo_full(tb):
    return geocoded(tb)


_FALLBACK = """
select id, address, retry, step, status, reason,
       cast(least(refused, 2) as integer) as fallback_step,
       '{"countrySet":"ZA"'
         || case when refused >= 2 then '' else ',"idxSet":"Geo,Addr"' end
         || case when refused >= 1 then '' else ',"language":"en-ZA"' end
         || ',"limit":"5","maxFuzzyLevel":"2","minFuzzyLevel":"1","view":"Unified"}'
         as parameters
from (
  select *, coalesce(count(*) filter (status = 400) over (
              partition by id, address, retry order by step
              rows between unbounded preceding and 1 preceding), 0) as refused
  from attempts)"""


@query("geo_fallback_params", with_tables(_FALLBACK))
def geo_fallback_params(tb):
    return fallback_parameters(tb.geocode_log(), PARAMETERS).drop("body")


@query(
    "flood_attempts",
    select("batch_id, answered, deciding_retry, status, body, error", "flood_attempts"),
)
def flood_attempts(tb):
    return batch_outcomes(tb.flood_requests(), tb.flood_log(), ["batch_id"])


@query("flood_request_items", select("id, wkt_geometry, buffer", "items"))
def flood_request_items(tb):
    return request_items(geocoded(tb))


@query(
    "flood_batches",
    with_tables("""
select cast(n // 200 + 1 as integer) as wave, cast(n % 200 // 10 + 1 as integer) as batch,
       cast(count(*) as integer) as item_count,
       '{"country_code":"ZA","geometries":[' || string_agg(
         '{"id":"' || id || '","wkt_geometry":"' || wkt_geometry || '","buffer":' || buffer || '}',
         ',' order by n) || ']}' as body
from (select *, row_number() over (order by id, wkt_geometry, buffer) - 1 as n from items)
group by n // 200, n % 200 // 10"""),
)
def flood_batches(tb):
    return request_batches(request_items(geocoded(tb)), batches_per_wave=20)


@query(
    "flood_flatten",
    with_tables(f"""
select address_id, batch_id, {", ".join(f"round({c} + 1e-8, 6) as {c}" for c in DEPTH_COLUMNS)}
from (select * from depth_items union all select * from depth_items where twice)"""),
)
def flood_flatten(tb):
    return flat_depths(tb.flood_depths()).drop("position")


@query(
    "flood_flatten_scores",
    with_tables(f"""
select address_id, batch_id, {", ".join(f"round({c} + 1e-8, 6) as {c}" for c in SCORE_NAMES)}
from (select * from score_items union all select * from score_items where twice)"""),
)
def flood_flatten_scores(tb):
    return flat_scores(tb.flood_scores()).drop("position")


@query(
    "flood_dead_letters",
    with_tables("""
select c_custkey // 10 as batch_id, '[{"id":"' || c_custkey || '"},{"id":"' as body,
       'unreadable answer: [{"id":"' || c_custkey || '"},{"id":"' as error
from customer where c_custkey % 100 = 0"""),
)
def flood_dead_letters(tb):
    return unreadable_responses(tb.flood_depths())


@query("flood_merge", select(f"address_id, {DEPTHS}, {SCORES}", "merged"))
def flood_merge(tb):
    return merge_depths_and_scores(flat_depths(tb.flood_depths()), flat_scores(tb.flood_scores()))


@query(
    "flood_full",
    select(
        GEOCODE.replace("id, ", "address_id, ", 1)
        + f", t:geocoded_at, {DEPTHS}, {SCORES}, t:risk_computed_at",
        "flood",
    ),
)
def flood_full(tb):
    return build_flood_risk(geocoded(tb), tb.flood_depths(), tb.flood_scores(), run_ts())


@query(
    "enrich_partitions",
    with_tables("""
select id, wkt_geometry,
       case when id not like '%5' then round(cast(id as bigint) * 7 % 100 / 100.0::double + 1e-8, 6) end
         as answer,
       case when id like '%5' then 'no route' end as error
from items"""),
)
def enriched_items(tb):
    def answers(batch: pd.DataFrame) -> pd.DataFrame:
        """Stands in for a service: computed from the request alone; some ids never get through."""
        if batch["id"].str.endswith("5").any():
            raise ConnectionError("no route")
        answer = batch["id"].astype("int64") * 7 % 100 / 100.0
        return batch[["id", "wkt_geometry"]].assign(answer=answer)

    return enrich_partitions(
        request_items(geocoded(tb)),
        answers,
        "id string, wkt_geometry string, answer double, error string",
        batch_size=1,
        wait_seconds=0,
    )
