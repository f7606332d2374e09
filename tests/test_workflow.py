"""The README's step-by-step workflow on a generated ratings file."""

import os

from cinerank.operators import knn, quality as Q, split as S, tuning as T
from cinerank.plans import workflows as W
from cinerank.sources import files, store, synthetic


def test_readme_workflow(spark, tmp_dir):
    gen = synthetic.generate_ratings(spark, 2000)            # the reference's sample data shape
    path = os.path.join(tmp_dir, "ratings_tsv")
    files.write_ratings(gen, path, fmt="csv", sep="\t")

    raw = files.read_ratings_tsv(spark, path)
    report = Q.validation_report(Q.dedup_latest(raw)).first()
    assert report.error is None and report.rows_retained > 1500
    clean = W.ingest_strict(raw, output=os.path.join(tmp_dir, "clean"))
    assert clean.count() == report.rows_retained

    cells, sims, stats, lookups = W.prepare_features(clean, os.path.join(tmp_dir, "features"))
    result = W.train(spark, cells, clean, tune=True)
    store.save_model(result.model, os.path.join(tmp_dir, "model"))
    scored = result.model.predict(clean)
    rep = W.evaluate(scored, clean, output=os.path.join(tmp_dir, "evaluation")).first()
    assert rep.coverage.coverage_ratio == 1.0                     # Q8: always 1.0 at 0.5
    recs = knn.recommend(cells, result.model.neighbors, result.model.train, result.model.k, n=5)
    assert recs.groupBy("user_id").count().where("count != 5").count() == 0
    sweep = T.sweep_k(cells, clean, S.split_users(cells))
    best = T.best_k(sweep, "rmse").first()
    assert best.k in (3, 5, 10, 15, 20) and best.coverage == 1.0
