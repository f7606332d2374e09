"""What training, evaluation and sweeps leave behind, and the helpers under them."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.functions import ranking
from cinerank.operators import features as Fe
from cinerank.operators import knn, quality as Q, tuning as T
from cinerank.plans import workflows as W
from cinerank.sources import files, store

CELLS = "user_id long, movie_id long, rating double"


@pytest.fixture(scope="module")
def cells(spark):
    rng = np.random.default_rng(2)
    rows = [(u, m, float(rng.integers(1, 11)) / 2) for u in range(1, 25) for m in range(1, 15) if rng.random() < 0.5]
    return spark.createDataFrame(rows, CELLS).cache()


def test_training_artefacts_and_stored_evaluation(spark, cells, tmp_dir):
    out = W.train(spark, cells, cells, tune=True, k_values=(2, 3), output=f"{tmp_dir}/run")
    row, n = out.report.first(), cells.count()
    assert (row.n_train, row.n_val) == (int(0.8 * n), n - int(0.8 * n))
    best = min(out.tuning.collect(), key=lambda r: (r.rmse, r.position))
    assert (row.k, row.rmse) == (best.k, best.rmse)
    meta = files.read_json_dict(spark, f"{tmp_dir}/run/metadata")
    assert meta["training"]["n_train"] == row.n_train and meta["evaluation"]["rmse"] == row.rmse
    assert {r.k for r in files.read_report(spark, f"{tmp_dir}/run/tuning_results").collect()} == {2, 3}
    cells.write.parquet(f"{tmp_dir}/all")
    report = W.evaluate_stored(spark, f"{tmp_dir}/run", f"{tmp_dir}/all", f"{tmp_dir}/all", f"{tmp_dir}/report").first()
    assert report.test_set.n_samples == n and "n_train" in report.metadata and os.path.isdir(f"{tmp_dir}/report")


def test_sweep_leaves_runs(spark, cells, tmp_dir):
    log = T.RunLog(spark, f"{tmp_dir}/log")
    runs = W.sweep(spark, cells, cells, f"{tmp_dir}/sweep", k_values=(2, 3, 0), log=log)
    saved = files.read_json_dict(spark, f"{tmp_dir}/sweep/results")["runs"]
    assert saved == runs and [r["status"] for r in runs] == ["completed", "completed", "failed"]
    assert len({r["run_id"] for r in runs}) == 3 and runs[0]["training_time_seconds"] > 0
    assert store.load_model(runs[0]["model"], spark).k == 2
    ranked = log.comparison("knn_sweep").orderBy("leaderboard_rank").collect()
    assert [r.leaderboard_rank for r in ranked] == [1, 2, 3] and ranked[2].rmse is None


def test_quantiles_by_brackets(spark, monkeypatch):
    rng = np.random.default_rng(3)
    values = np.round(rng.normal(size=4000), 2).tolist() + [0.25] * 500
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.77, "e": 1.0}
    for limit in (100_000, 50):
        monkeypatch.setattr(ranking, "BRACKET_ROWS", limit)
        monkeypatch.setattr(ranking, "ACCURACY", 200)
        got = ranking.exact_quantiles(df, "x", probs).first()
        assert [got[k] for k in probs] == pytest.approx([np.quantile(values, p) for p in probs.values()], abs=1e-12)


def test_requests_rejected_with_a_reason(spark, cells):
    req = spark.createDataFrame([(1, 5), (2, 0), (3, 51), (99, 5), (4, None)], "user_id long, n int")
    got = {r.user_id: r.reason for r in knn.rejected_requests(cells, req).collect()}
    assert got == {2: "n outside 1..50", 3: "n outside 1..50", 99: "unknown user", 4: "n outside 1..50"}


def test_large_catalogue_joins_salted_copies(spark, cells, monkeypatch):
    nbrs = Fe.similar_users(cells, 3)
    want = sorted(map(tuple, knn.recommend(cells, nbrs, cells, 3).collect()))
    monkeypatch.setattr(knn, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, knn.recommend(cells, nbrs, cells, 3).collect())) == want


def test_undeclared_movie_fails_and_nothing_cleaned(spark, cells, tmp_dir):
    with pytest.raises(Exception, match="declared list"):
        Fe.rating_matrix(cells, [1, 2]).collect()
    with pytest.raises(ValueError):
        files.write_ratings(cells.limit(0), f"{tmp_dir}/none")


def test_text_ids_and_times_compare_as_numbers(spark):
    raw = spark.createDataFrame([("1", "1", "4.0", "978300000"), ("01", "1.0", "2.0", "1100000000"),
                                 ("9007199254740993", "1", "3", "1000000000")], "user_id string, movie_id string, rating string, timestamp string")
    typed = Q.coerce_types(raw)
    assert [r.user_id for r in typed.collect()] == [1, 1, 9007199254740993]
    assert [(r.user_id, r.rating) for r in Q.ingest_strict(raw).collect()] == [(1, 2.0)]


def test_stage_tables_are_released(spark, cells):
    ranking.reliable_checkpoint(cells).count()
    folders = ranking.stage_tables(spark)
    assert folders
    ranking.release_stages(spark)
    assert not ranking.stage_tables(spark) and not any(os.path.exists(f.removeprefix("file:")) for f in folders)
    assert cells.select(F.count("*")).first()[0]
