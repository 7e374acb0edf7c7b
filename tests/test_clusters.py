import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarmac.operators.clusters import (
    CELL,
    fit_month,
    mean_shift,
    neighbour_bandwidth,
    nearest_center,
    score_centers,
    score_histogram,
    score_sample,
)


def bandwidth_by_pairs(points, share=0.3):
    k = max(int(len(points) * share), 1)
    gaps = np.sort(np.abs(points[:, None] - points[None, :]), axis=1)
    return gaps[:, k - 1].mean()


def shift_by_points(points, bandwidth):
    """Mean shift point by point, with no sorting and no sums kept."""
    seeds = np.unique(np.round(points / bandwidth)) * bandwidth
    found = {}
    for centre in seeds:
        for _ in range(301):
            reach = points[np.abs(points - centre) <= bandwidth]
            if not len(reach):
                break
            step, centre = abs(reach.mean() - centre), reach.mean()
            if step <= 1e-3 * bandwidth:
                break
        if len(reach):
            found[round(centre, 12)] = len(reach)
    kept = []
    for centre in sorted(found, key=lambda c: (found[c], c), reverse=True):
        if all(abs(centre - k) > bandwidth for k in kept):
            kept.append(centre)
    return sorted(kept)


def counted(points):
    return np.unique(points, return_counts=True)


@pytest.mark.parametrize("seed", range(8))
def test_fit_agrees_with_brute_force(seed):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(m, 0.03, 80) for m in rng.uniform(0.1, 0.9, 3)]
    points = np.round(np.clip(np.concatenate(parts), 0, 1), 2 if seed % 2 else 8)
    if seed > 5:  # a cell with most of the clients beside light ones
        points = np.concatenate([points, np.full(400, points[0])])
    bandwidth = neighbour_bandwidth(*counted(points))
    assert bandwidth == pytest.approx(max(bandwidth_by_pairs(points), 1e-3), abs=1e-8)
    assert mean_shift(*counted(points), bandwidth) == pytest.approx(
        shift_by_points(points, bandwidth), abs=1e-9
    )


def test_two_separate_groups():
    values = np.array([0.2, 0.22, 0.24, 0.7, 0.72])
    centres = mean_shift(values, np.array([1, 2, 1, 3, 1]), 0.1)
    assert centres == [pytest.approx(0.22), pytest.approx(0.705)]


def test_bandwidth_has_a_floor_and_a_fallback():
    assert neighbour_bandwidth(*counted(np.array([0.4]))) == 1e-3
    assert neighbour_bandwidth(*counted(np.full(20, 0.4))) == 1e-3
    assert neighbour_bandwidth(*counted(np.linspace(0.4, 0.400001, 50))) == 1e-3
    points = np.array([0.0] * 2 + [1.0] * 2)  # one neighbour each: the point itself
    expected = 1.06 * np.std(points, ddof=1) * 4 ** (-0.2)
    assert neighbour_bandwidth(*counted(points)) == pytest.approx(expected, abs=1e-8)


def test_a_centre_that_does_not_rest_stops_the_fit(monkeypatch):
    monkeypatch.setattr("tarmac.operators.clusters.MAX_STEPS", 0)
    with pytest.raises(RuntimeError, match="does not rest"):
        mean_shift(np.array([0.1, 0.16, 0.3]), np.array([1, 5, 40]), 0.2)


def test_the_fit_reads_every_client_whatever_its_key(spark):
    """Scores that rise with the key: a prefix of the keys would miss whole groups."""
    clients = spark.range(600_000).select(
        F.format_string("p%09d", "id").alias("policy_number"),
        F.lit("i").alias("item_no"),
        F.lit("d").alias("imei_number"),
        F.lit("s").alias("sentiance_id"),
        (F.floor(F.col("id") / 200_000) * 0.4 + (F.col("id") % 97) / 97 * 0.02).alias("driving_score"),
    )
    cells = score_histogram(clients, "202401")
    assert cells.agg(F.sum("clients")).first()[0] == 600_000 and cells.count() < 0.9 / CELL
    fitted = score_centers(clients, "202401").orderBy("ms_cluster").toPandas()
    assert fitted["ms_center"].tolist() == pytest.approx([0.01, 0.41, 0.81], abs=0.01)
    assert nearest_center(clients, score_centers(clients, "202401")).agg(
        F.count_distinct("nearest_ms_cluster")
    ).first()[0] == 3


def test_histogram_fit_is_exact_to_the_cell(spark):
    rng = np.random.default_rng(7)
    scores = np.concatenate([rng.normal(0.3, 0.02, 400), rng.normal(0.8, 0.02, 400)])
    frame = spark.createDataFrame(pd.DataFrame({"driving_score": scores}))
    fitted = score_centers(frame, "202401").orderBy("ms_cluster").toPandas()
    exact = fit_month("202401", pd.DataFrame({"value": scores, "clients": 1}))
    assert fitted["ms_center"].tolist() == pytest.approx(exact["ms_center"].tolist(), abs=2 * CELL)
    assert fitted["bandwidth"][0] == pytest.approx(exact["bandwidth"][0], abs=2 * CELL)
    nobody = frame.filter("driving_score is null")
    assert score_centers(nobody, "202401").count() == 0


def test_the_sample_is_the_same_share_on_every_run(spark):
    frame = spark.range(3000).selectExpr(
        "concat('p', id) as policy_number", "concat('i', id) as item_no", "'d' as imei_number",
        "concat('s', id) as sentiance_id", "id / 3000 as driving_score",
    )
    kept = score_sample(frame)
    assert 500 < kept.count() < 700 and kept.agg(F.max("unit_hash")).first()[0] < 0.2
    again = score_sample(frame.repartition(5))
    assert sorted(kept.collect()) == sorted(again.collect())
