"""Evaluation metrics against numpy."""

import numpy as np
import pytest

from cinerank.functions.ranking import exact_quantiles, with_dense_index
from cinerank.operators import evaluate as E

SCORED = "user_id long, movie_id long, rating double, prediction double"


def scored(spark, errors, user_of=None):
    rows = [((user_of or (lambda i: i))(i), i, 5.0, 5.0 - e) for i, e in enumerate(errors)]
    return spark.createDataFrame(rows, SCORED)


def test_histogram_edges_and_empty_bins(spark):
    h = {r.bin: r["count"] for r in E.error_histogram(scored(spark, [0.5, 2.0, 4.5, 5.0])).collect()}
    assert h == {"error_0.0_0.5": 0, "error_0.5_1.0": 1, "error_1.0_1.5": 0,
                 "error_1.5_2.0": 0, "error_2.0_5.0": 2}


def test_engagement_edges_and_missing_segment(spark):
    counts = {1: 5, 2: 6, 3: 20, 4: 21}
    rows, i = [], 0
    for u, n in counts.items():
        for _ in range(n):
            rows.append((u, i, 4.0, 3.0))
            i += 1
    seg = {r.segment: (r.n_samples, r.mae, r.mean_engagement)
           for r in E.engagement_segments(spark.createDataFrame(rows, SCORED)).collect()}
    assert seg["low"] == (5, 1.0, 5.0)
    assert seg["medium"] == (26, 1.0, (6 * 6 + 20 * 20) / 26)
    assert seg["high"] == (21, 1.0, 21.0)
    only_low = spark.createDataFrame([(1, 1, 4.0, 3.5)], SCORED)
    assert [r.segment for r in E.engagement_segments(only_low).collect()] == ["low"]


def test_metrics_and_percentiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    err = np.round(rng.random(101) * 3, 3)
    df = scored(spark, err.tolist())
    m = E.rating_metrics(df).first()
    assert m.rmse == pytest.approx(np.sqrt(np.mean(err ** 2)), abs=1e-6)
    assert m.median_error == pytest.approx(np.median(err), abs=1e-6)
    assert m.std_error == pytest.approx(np.std(err), abs=1e-6)
    p = E.error_percentiles(df).first()
    want = np.percentile(err, [25, 50, 75, 90, 95])
    assert [p.p25, p.p50, p.p75, p.p90, p.p95] == pytest.approx(want.tolist(), abs=1e-6)


def test_exact_quantiles_single_and_even(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "v double")
    q = exact_quantiles(df, "v", {"a": 0.25, "m": 0.5, "z": 1.0}).first()
    assert (q.a, q.m, q.z) == (1.75, 3.0, 8.0)
    one = spark.createDataFrame([(7.0,)], "v double")
    assert exact_quantiles(one, "v", {"m": 0.5}).first().m == 7.0


def test_dense_index_is_global_order(spark):
    df = spark.range(0, 1000, 3).withColumnRenamed("id", "x").repartition(7)
    got = sorted((r.x, r.idx) for r in with_dense_index(df, ["x"], num_partitions=5).collect())
    assert [i for _, i in got] == list(range(len(got)))


def test_coverage_baselines_and_verdict(spark):
    rows = [(1, 1, 4.0, 3.0), (2, 1, 2.0, 0.5), (1, 2, 5.0, 0.5), (3, 3, 1.0, 4.0)]
    df = spark.createDataFrame(rows, SCORED)
    c = E.catalog_coverage(df, 3.5).first()
    assert (c.n_recommended, c.n_total) == (1, 3)
    assert E.coverage_verdict(E.catalog_coverage(df, 3.5)).first().verdict == "low"
    assert E.coverage_verdict(E.catalog_coverage(df, 0.5)).first().verdict == "good"
    b = E.baselines(df).first()
    r = np.array([4.0, 2.0, 5.0, 1.0])
    assert b.mean_rmse == pytest.approx(np.sqrt(np.mean((r - r.mean()) ** 2)), abs=1e-6)
    assert b.median_value == pytest.approx(np.median(r))
    assert b.best_baseline_rmse == min(b.mean_rmse, b.median_rmse, b.neutral_rmse)
    assert b.mean_rmse <= b.median_rmse and b.mean_rmse <= b.neutral_rmse


def test_sparsity_and_per_stats(spark):
    df = spark.createDataFrame([(1, 1, 4.0, 0), (1, 2, 3.0, 0), (2, 1, 5.0, 0)],
                               "user_id long, movie_id long, rating double, timestamp long")
    s = E.sparsity(df, n_movies=4).first()
    assert (s.n_users, s.n_movies, s.n_ratings, s.max_possible, s.density) == (2, 4, 3, 8, 0.375)
    u = E.ratings_per_stats(df, "user_id").first()
    assert (u["mean"], u["median"], u["min"], u["max"]) == (1.5, 1.5, 1, 2)


def test_report_row(spark):
    rows = [(u, m, 3.0 + (u % 2), 3.5) for u in range(1, 8) for m in range(1, 4)]
    df = spark.createDataFrame(rows, SCORED)
    rep = E.evaluation_report(df, df.drop("prediction"), {"k": 5}).first()
    assert rep.test_set.n_samples == 21
    assert rep.rating_prediction.rmse == pytest.approx(0.5)
    assert len(rep.error_distribution.bins) == 5
