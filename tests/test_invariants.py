"""SURVEY 5(d) invariants on the derived sf0.001 tables."""

import pytest
from pyspark.sql import functions as F

from cinerank.operators import evaluate as E
from cinerank.operators import features as Fe
from cinerank.operators import knn, split as S
from cinerank.plans import context as C

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    cells, nbrs, train, val = C.model_parts(spark, SF)
    return cells, nbrs, train, val


def test_similarity_invariants(spark, model):
    cells = model[0]
    sims = Fe.user_similarity(cells)
    rows = {(r.user_id, r.neighbor_id): r.similarity for r in sims.collect()}
    assert rows
    for (a, b), s in rows.items():
        assert a != b
        assert 0 < s <= 1 + 1e-12
        assert rows[(b, a)] == s


def test_prediction_and_recommendation_invariants(spark, model):
    cells, nbrs, train, val = model
    p = knn.predict(val, nbrs, train, 5)
    r = p.agg(F.min("prediction"), F.max("prediction"), F.count(F.lit(1))).first()
    assert 0.5 <= r[0] and r[1] <= 5.0 and r[2] == val.count()
    recs = knn.recommend(cells, nbrs, train, 5, n=5)
    assert recs.join(cells, ["user_id", "movie_id"]).count() == 0       # never a rated movie
    per_user = recs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("r"))
    assert per_user.where("n != 5 OR r != 5").count() == 0


def test_split_and_histogram_invariants(spark, model):
    cells = model[0]
    s = S.split_rows(cells)
    tr, va = S.side(s, "train"), S.side(s, "val")
    assert tr.count() + va.count() == cells.count()
    assert tr.join(va, ["user_id", "movie_id"]).count() == 0
    scored = knn.predict(va, model[1], tr, 5)
    hist = E.error_histogram(scored).agg(F.sum("count")).first()[0]
    over = scored.where(F.abs(F.col("rating") - F.col("prediction")) >= 5).count()
    assert hist + over == scored.count()
    b = E.baselines(scored).first()
    assert b.mean_rmse <= b.median_rmse + 1e-9 and b.mean_rmse <= b.neutral_rmse + 1e-9
