import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

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
    require_answered,
    resolved_addresses,
    unreadable_responses,
)
from tarmac.plans.flood import build_flood_risk
from tarmac.plans.geocode import build_geocoded
from tarmac.schemas import FLOOD_SCORE_NAMES, GEOCODE_COLUMNS, flood_depth_paths

LOG_DDL = "id string, address string, retry int, step int, status int, reason string, body string"


def run_time():
    return F.lit("2026-04-02 06:00:00").cast("timestamp")


def found(*towns):
    results = [
        {
            "type": "Point Address",
            "score": 9.5 - i,
            "address": {"freeformAddress": f"1 {town}", "countryCode": "ZA", "municipality": town},
            "position": {"lat": -26.5 - i, "lon": 28.25},
        }
        for i, town in enumerate(towns)
    ]
    return json.dumps({"results": results})


def addresses(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id string, address string")


def log(spark, *rows):
    return spark.createDataFrame(list(rows), LOG_DDL)


def test_best_match_for_each_address(spark):
    source = addresses(spark, ("1", "a"), ("2", "b"))
    attempts = log(
        spark,
        ("1", "a", 1, 0, 200, "OK", found("Paarl", "Ceres")),
        ("2", "b", 1, 0, 200, "OK", found("George")),
    )
    geocoded = build_geocoded(source, attempts, run_time())
    assert tuple(geocoded.columns) == (*GEOCODE_COLUMNS, "geocoded_at")
    rows = {r.id: r for r in geocoded.collect()}
    assert rows["1"].municipality == "Paarl" and rows["1"].lat == -26.5
    assert rows["1"].scoreRank == 1 and rows["1"].error is None
    assert rows["2"].municipality == "George"
    candidates = geocode_candidates(resolved_addresses(source, attempts))
    assert candidates.count() == 3
    best = best_candidates(candidates)
    assert sorted(map(str, best.collect())) == sorted(
        map(str, geocoded.drop("geocoded_at").collect())
    )


def test_reasons_for_addresses_without_match(spark):
    source = addresses(
        spark, ("0", ""), ("1", "a"), ("2", "b"), ("3", "c"), ("4", "d"), ("5", None), ("6", "e"), ("7", "f")
    )
    attempts = log(
        spark,
        ("1", "a", 1, 0, 200, "OK", '{"results":[]}'),
        *[("2", "b", n, 0, 503, "Down", "y" * 400) for n in (1, 2, 3, 4)],
        *[("3", "c", n, 0, 429, "Slow", "") for n in (1, 2, 3)],
        ("6", "e", 1, 0, 500, "Down", "x"),
        ("6", "e", 2, 0, None, "Connection refused", None),
        ("7", "f", 1, 0, None, None, None),
    )
    rows = {r.id: r for r in build_geocoded(source, attempts, run_time()).collect()}
    assert rows["0"].error == rows["5"].error == "empty address"
    assert rows["1"].error == "no results"
    assert rows["2"].error == "503 Down: " + "y" * 400
    assert rows["3"].error == "rate limited"
    assert rows["4"].error == "no attempt"
    assert (rows["6"].error, rows["7"].error) == ("Connection refused", "no answer")
    assert all(r.lat is None and r.scoreRank is None for r in rows.values())
    assert rows["2"].inputAddress == "b"
    [cut] = resolved_addresses(source, attempts, max_text=3).filter("id = '2'").collect()
    assert cut.error == "503 Down: yyy"


def test_first_success_wins_however_late(spark):
    attempts = log(
        spark,
        ("1", "a", 1, 0, 429, "Slow", ""),
        ("1", "a", 2, 0, 200, "OK", found("Paarl")),
        ("1", "a", 5, 0, 200, "OK", found("Too late")),
        *[("2", "b", retry, step, 400, "Bad", "") for retry in (1, 2) for step in (0, 1, 2)],
        ("2", "b", 9, 1, 200, "OK", found("George")),
        ("3", "c", 1, 0, 500, "Bad", "first"),
        ("3", "c", 1, 1, None, "reset", None),
        ("3", "c", 2, 0, 502, "Worse", "second"),
    )
    rows = {r.id: r for r in final_outcomes(attempts).collect()}
    assert (rows["1"].status, rows["1"].deciding_retry) == (200, 2)
    assert (rows["2"].status, rows["2"].deciding_retry, rows["2"].deciding_step) == (200, 9, 1)
    assert (rows["3"].status, rows["3"].body) == (502, "second")


GARBLED = ['{"results":[{"type":"Poi', "<html>busy</html>", "", None, "{} trailing", "   "]


def test_an_unreadable_answer_is_a_failure(spark):
    source = addresses(spark, *[(str(n), "a") for n in range(len(GARBLED))], ("later", "b"), ("worse", "c"), ("none", "d"))
    attempts = log(
        spark,
        *[(str(n), "a", 1, 0, 200, "OK", body) for n, body in enumerate(GARBLED)],
        ("later", "b", 1, 0, 200, "OK", GARBLED[0]),
        ("later", "b", 2, 0, 200, "OK", found("Paarl")),
        ("worse", "c", 1, 0, 200, "OK", GARBLED[1]),
        ("worse", "c", 2, 0, 503, "Down", "x"),
        ("none", "d", 1, 0, 200, "OK", "{}"),
    )
    rows = {r.id: r for r in build_geocoded(source, attempts, run_time()).collect()}
    for n, body in enumerate(GARBLED):
        assert rows[str(n)].error == "unreadable answer: " + (body or "")
    assert (rows["later"].municipality, rows["later"].error) == ("Paarl", None)
    assert (rows["worse"].error, rows["none"].error) == ("503 Down: x", "no results")
    [cut] = resolved_addresses(source, attempts, max_text=5).filter("id = '1'").collect()
    assert cut.error == "unreadable answer: <html"


def test_flood_bodies_are_opened_or_dead_letters(spark):
    whole = [json.dumps([depth("8", "FLRF_U", sop=3)]), " []"]
    broken = [*GARBLED, '[{"id":"7"},{"id":"8","sta', '{"id":"7"}']
    responses = spark.createDataFrame(list(enumerate(whole + broken)), "batch_id long, body string")
    letters = unreadable_responses(responses).collect()
    assert sorted(r.batch_id for r in letters) == list(range(2, 2 + len(broken)))
    assert {r.error for r in letters} == {"unreadable answer: " + (body or "") for body in broken}
    assert [r.address_id for r in flat_depths(responses).collect()] == ["8"]
    assert flat_scores(responses).count() == 1
    assert unreadable_responses(responses.limit(0)).count() == 0


def test_a_failed_batch_stops_the_job_on_request(spark):
    requests = spark.createDataFrame([(1,), (2,)], "batch int")
    rows = [(1, 1, 200, "OK", "[{"), (1, 2, 200, "OK", "[]"), (2, 1, 200, "OK", "[{")]
    attempts = spark.createDataFrame(rows, "batch int, retry int, status int, reason string, body string")
    outcomes = batch_outcomes(requests, attempts, ["batch"])
    assert {r.batch: (r.answered, r.deciding_retry, r.body, r.error) for r in outcomes.collect()} == {
        1: (True, 2, "[]", None), 2: (False, 1, None, "[batch 2/2] unreadable answer: [{"),
    }
    assert require_answered(outcomes.filter("batch = 1")).count() == 1
    places, nothing = located(spark, ("7", "Quay", 1.0, 2.0)), bodies(spark)
    with pytest.raises(RuntimeError, match="batch 2/2"):
        build_flood_risk(places, nothing, nothing, run_time(), outcomes=outcomes)


def test_an_id_with_several_addresses_takes_its_best_match(spark):
    source = addresses(spark, ("1", ""), ("1", "12 Main"), ("2", "new"), ("2", "old"), ("2", "old"), ("3", ""), ("3", None))
    attempts = log(
        spark,
        ("1", "12 Main", 1, 0, 200, "OK", found("Paarl")),
        ("2", "new", 1, 0, 200, "OK", '{"results":[]}'),
        ("2", "old", 1, 0, 200, "OK", found("Ceres")),
    )
    rows = {r.id: r for r in build_geocoded(source, attempts, run_time()).collect()}
    assert (rows["1"].municipality, rows["1"].inputAddress) == ("Paarl", "12 Main")
    assert (rows["2"].municipality, rows["2"].inputAddress) == ("Ceres", "old")
    assert rows["3"].error == "empty address"
    top = best_candidates(geocode_candidates(resolved_addresses(source, attempts)))
    assert {r.id: r.municipality for r in top.collect()} == {i: r.municipality for i, r in rows.items()}


def test_parameters_shrink_after_each_400_and_start_again(spark):
    statuses = [(1, 0, 400), (1, 1, 400), (1, 2, 503), (2, 0, 400), (2, 1, 200)]
    attempts = log(spark, *[("1", "a", r, s, status, "", "") for r, s, status in statuses])
    sent = fallback_parameters(attempts, {"language": "en", "idxSet": "Geo", "limit": "5"})
    got = {(r.retry, r.step): set(json.loads(r.parameters)) for r in sent.collect()}
    full = {"language", "idxSet", "limit"}
    assert got == {
        (1, 0): full, (1, 1): full - {"language"}, (1, 2): {"limit"},
        (2, 0): full, (2, 1): full - {"language"},
    }


def test_empty_source_keeps_its_columns(spark):
    geocoded = build_geocoded(addresses(spark), log(spark), run_time())
    assert geocoded.count() == 0 and geocoded.schema["lat"].dataType.simpleString() == "double"


def test_source_columns_are_required(spark):
    with pytest.raises(ValueError, match="address"):
        require_columns(spark.createDataFrame([(1,)], "id int"), ["id", "address"], "address_source")


def located(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, inputAddress string, lat double, lon double")


def test_items_need_both_coordinates(spark):
    places = {"north": (-23.9, 29.45), "sea": (-34.36, None), "gap": (None, 18.47), "zero": (0.0, 0.0)}
    items = request_items(located(spark, *[(k, k.upper(), *p) for k, p in places.items()]))
    got = {r.id: (r.wkt_geometry, r.buffer) for r in items.collect()}
    assert got == {"north": ("POINT(29.45 -23.9)", 100), "zero": ("POINT(0.0 0.0)", 100)}


@pytest.mark.parametrize("metres", [501, 100_000])
def test_buffer_is_limited(spark, metres):
    with pytest.raises(ValueError, match="buffer"):
        request_items(located(spark, ("far", "", 1.0, 2.0)), metres)


def test_batches_and_waves_hold_every_item_once(spark):
    df = spark.range(37).select(
        F.format_string("k%03d", F.col("id") * 3).alias("id"),
        F.concat(F.lit("POINT("), F.col("id").cast("string"), F.lit(" 5)")).alias("wkt_geometry"),
        F.lit(250).alias("buffer"),
    )
    rows = request_batches(df.union(df.filter("id > 'k050'"))).orderBy("wave", "batch").collect()
    assert [r.item_count for r in rows] == [10, 10, 10, 7] and {r.wave for r in rows} == {1}
    sent = [g for r in rows for g in json.loads(r.body)["geometries"]]
    assert [g["id"] for g in sent] == [f"k{3 * n:03d}" for n in range(37)]
    assert {g["buffer"] for g in sent} == {250} and sent[4]["wkt_geometry"] == "POINT(4 5)"
    assert {json.loads(r.body)["country_code"] for r in rows} == {"ZA"}
    waves = request_batches(df, items_per_batch=5, batches_per_wave=3).orderBy("wave", "batch").collect()
    assert [(r.wave, r.batch) for r in waves] == [(n // 3 + 1, n % 3 + 1) for n in range(8)]
    assert request_batches(df, batches_per_wave=2, max_waves=2).count() == 4
    with pytest.raises(Exception, match="too many items"):
        request_batches(df, batches_per_wave=2, max_waves=1).collect()


def test_no_items_no_batches(spark):
    empty = spark.createDataFrame([], "id string, wkt_geometry string, buffer int")
    assert request_batches(empty).count() == 0


def bodies(spark, *batches):
    rows = [(i, json.dumps(batch)) for i, batch in enumerate(batches)]
    return spark.createDataFrame(rows, "batch_id long, body string")


def depth(key, peril, **values):
    return {"id": key, "stats": {peril: values}}


def test_flood_answers_merge_and_flatten(spark):
    places = [("7", "Quay", -33.9, 18.4), ("8", "Dune", -34.1, 18.9), ("9", "Hill", -33.5, 18.6), ("10", "?", 3.0, None)]
    scores = bodies(
        spark,
        [{"id": "8", "Floodability_Def": 31}, {"id": "10", "FloodScore_UD": 12}],
        [{"id": "7", "Surfacewater_Floodscore_UD": 55, "FloodScore_Def": 6}, {"id": "8", "Floodability_Def": 99}],
    )
    depths = bodies(
        spark,
        [depth("8", "FLRF_U", rp_500={"max500": 1.75, "std_dev": 0.1}), depth("10", "FLRF_U", sop=3)],
        [depth("7", "FLSW_U", rp_50={"min50": 0.2}), depth("9", "FLRF_U", sop=20)],
        [depth("8", "FLRF_U", rp_500={"max500": 9.0})],
    )
    rows = {r.address_id: r for r in build_flood_risk(located(spark, *places), depths, scores, run_time()).collect()}
    assert set(rows) == {"7", "8"}  # no score for 9, no place for 10
    quay, dune = rows["7"], rows["8"]
    assert dune.river_flood_rp500_max_depth_meters == 1.75  # the first answer counts
    assert (dune.river_flood_rp500_std_dev_depth_meters, dune.floodability_defended) == (0.1, 31)
    assert quay.surface_water_flood_rp50_min_depth_meters == 0.2
    assert (quay.surface_water_flood_score_undefended, quay.overall_flood_score_defended) == (55, 6)
    assert quay.river_flood_standard_of_protection_rp is None and dune.inputAddress == "Dune"


def test_an_empty_side_leaves_nothing_or_the_other(spark):
    depths = bodies(spark, [depth("p", "FLRF_U", sop=40), depth("q", "FLRF_U", sop=41)])
    scores = bodies(spark, [{"id": "q", "FloodScore_UD": 17}])
    nothing = spark.createDataFrame([], "batch_id long, body string")

    def ids(d, s, **how):
        merged = merge_depths_and_scores(flat_depths(d), flat_scores(s), **how)
        return sorted(r.address_id for r in merged.collect())

    assert ids(depths, scores) == ids(depths, scores, when_one_side_empty="other") == ["q"]
    assert ids(depths, nothing) == ids(nothing, scores) == []
    assert ids(depths, nothing, when_one_side_empty="other") == ["p", "q"]
    assert ids(nothing, scores, when_one_side_empty="other") == ["q"]
    assert ids(nothing, nothing, when_one_side_empty="other") == []
    with pytest.raises(ValueError, match="when_one_side_empty"):
        ids(depths, scores, when_one_side_empty="both")


def test_addresses_without_place_have_no_risk(spark):
    places = located(spark, ("u", "", None, 20.0), ("v", "", -30.0, None))
    depths = bodies(spark, [depth("u", "FLRF_U", sop=1), depth("v", "FLSW_U")])
    scores = bodies(spark, [{"id": "u"}, {"id": "v"}])
    assert build_flood_risk(places, depths, scores, run_time()).count() == 0


def test_every_batch_has_one_outcome(spark):
    requests = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (2, 2)], "wave int, batch int")
    rows = [
        (1, 1, 1, 500, "Down", "a"), (1, 1, 2, 200, "OK", "[1]"), (1, 2, 1, None, "Timed out", None),
        (2, 1, 1, 429, "Slow", ""), (2, 1, 2, 503, "Down", "later"),
    ]
    attempts = spark.createDataFrame(rows, "wave int, batch int, retry int, status int, reason string, body string")
    got = {(r.wave, r.batch): (r.answered, r.body, r.error) for r in batch_outcomes(requests, attempts).collect()}
    assert got == {
        (1, 1): (True, "[1]", None),
        (1, 2): (False, None, "[batch 1.2/4] Timed out"),
        (2, 1): (False, None, "[batch 2.1/4] 503 Down: later"),
        (2, 2): (False, None, "no attempt"),
    }


def test_flat_names_are_distinct():
    names = [*flood_depth_paths().values(), *FLOOD_SCORE_NAMES.values()]
    assert len(names) == len(set(names)) == 68


def test_enrichment_asks_in_batches_and_again_after_failures(spark, tmp_path):
    marker = str(tmp_path / "failed")

    def fetch(batch: pd.DataFrame) -> pd.DataFrame:
        import os

        if not os.path.exists(marker):
            open(marker, "w").close()
            raise ConnectionError("once")
        return pd.DataFrame({"id": batch["id"], "size": len(batch)})

    df = spark.range(23).coalesce(1)
    rows = enrich_partitions(df, fetch, "id long, size int, error string", wait_seconds=0).collect()
    assert sorted(r.id for r in rows) == list(range(23))
    assert sorted({r["size"] for r in rows}) == [3, 10] and {r.error for r in rows} == {None}


def test_a_batch_that_keeps_failing_gives_error_rows(spark):
    def fetch(batch):
        if (batch["id"] == 4).any():
            raise ConnectionError("no route")
        return batch.assign(size=len(batch))

    rows = enrich_partitions(
        spark.range(9).coalesce(1), fetch, "id long, size int, error string", batch_size=3, wait_seconds=0
    ).collect()
    assert {r.id: (r["size"], r.error) for r in rows} == {
        n: (None, "no route") if 3 <= n <= 5 else (3, None) for n in range(9)
    }


def test_other_errors_end_the_job(spark):
    def fetch(batch):
        raise KeyError("a mistake")

    with pytest.raises(Exception, match="a mistake"):
        enrich_partitions(spark.range(3), fetch, "id long, error string").collect()
    with pytest.raises(ValueError, match="error"):
        enrich_partitions(spark.range(3), fetch, "id long")
