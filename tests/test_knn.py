"""K-NN prediction, recommendation, zero-fill, user-level K-NN and tuning,
each against a naive pure-Python implementation of the reference's rules."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.operators import features as Fe
from cinerank.operators import knn, split as S, tuning as T

SCHEMA = "user_id long, movie_id long, rating double"


def dense(rows):
    users = sorted({u for u, _, _ in rows})
    movies = sorted({m for _, m, _ in rows})
    x = {u: {} for u in users}
    for u, m, r in rows:
        x[u][m] = r
    return users, movies, x


def cos(a, b):
    dot = sum(a[m] * b[m] for m in a if m in b)
    if dot == 0:
        return 0.0
    return dot / (math.sqrt(sum(v * v for v in a.values())) * math.sqrt(sum(v * v for v in b.values())))


def naive_neighbors(x, u, k):
    sims = [(cos(x[u], x[v]), v) for v in x if v != u]
    sims = [(s, v) for s, v in sims if s > 0]
    sims.sort(key=lambda t: (-t[0], t[1]))
    return sims[:k]


def naive_predict(x, train, u, m, k):
    if u not in x:
        return 3.0
    nb = naive_neighbors(x, u, k)
    votes = [train[v][m] for _, v in nb if v in train and m in train[v]]
    if not votes:
        return 3.0
    return min(max(sum(votes) / len(votes), 0.5), 5.0)


def sample_rows(seed, n_users=25, n_movies=15, density=0.3):
    rng = np.random.default_rng(seed)
    return [(u, m, float(rng.integers(1, 11)) / 2)
            for u in range(1, n_users + 1) for m in range(1, n_movies + 1) if rng.random() < density]


def test_predict_matches_naive(spark):
    rows = sample_rows(1)
    cells = spark.createDataFrame(rows, SCHEMA)
    train_rows = [r for i, r in enumerate(rows) if i % 5]
    test_rows = [r for i, r in enumerate(rows) if not i % 5] + [(999999, 1, 3.0)]
    train = spark.createDataFrame(train_rows, SCHEMA)
    _, _, x = dense(rows)
    _, _, tr = dense(train_rows)
    nbrs = Fe.similar_users(cells, 3)
    got = {(r.user_id, r.movie_id): r.prediction
           for r in knn.predict(spark.createDataFrame(test_rows, SCHEMA), nbrs, train, 3).collect()}
    for u, m, _ in test_rows:
        assert got[(u, m)] == pytest.approx(naive_predict(x, tr, u, m, 3), abs=1e-12)
    assert got[(999999, 1)] == 3.0


def test_top_k_taken_before_rated_filter(spark):
    # user 1's nearest is user 2 (did not rate movie 9); user 3 did, but is second.
    rows = [(1, 1, 5.0), (1, 2, 5.0), (2, 1, 5.0), (2, 2, 5.0), (3, 1, 5.0), (3, 9, 4.0), (3, 3, 5.0)]
    cells = spark.createDataFrame(rows, SCHEMA)
    nbrs = Fe.similar_users(cells, 2)
    pairs = spark.createDataFrame([(1, 9, 0.0)], SCHEMA)
    assert knn.predict(pairs, nbrs, cells, 1).first().prediction == 3.0
    assert knn.predict(pairs, nbrs, cells, 2).first().prediction == 4.0


def test_weighted_mean(spark):
    rows = [(1, 1, 4.0), (2, 1, 4.0), (2, 5, 2.0), (3, 1, 1.0), (3, 5, 5.0)]
    cells = spark.createDataFrame(rows, SCHEMA)
    nbrs = Fe.similar_users(cells, 2)
    s = {(r.user_id, r.neighbor_id): r.similarity for r in nbrs.collect()}
    p = knn.predict(spark.createDataFrame([(1, 5, 0.0)], SCHEMA), nbrs, cells, 2, weighted=True).first()
    want = (2.0 * s[(1, 2)] + 5.0 * s[(1, 3)]) / (s[(1, 2)] + s[(1, 3)])
    assert p.prediction == pytest.approx(want, abs=1e-12)


def naive_recommend(x, train, movies, u, n, k):
    preds = [(naive_predict(x, train, u, m, k), m) for m in movies if m not in x[u]]
    preds.sort(key=lambda t: (-t[0], t[1]))
    return [m for _, m in preds[:n]]


@pytest.mark.parametrize("seed", [2, 3])
def test_recommend_matches_dense_definition(spark, seed):
    rows = sample_rows(seed, n_users=20, n_movies=30, density=0.2)
    cells = spark.createDataFrame(rows, SCHEMA)
    users, movies, x = dense(rows)
    nbrs = Fe.similar_users(cells, 3)
    got = {}
    for r in knn.recommend(cells, nbrs, cells, 3, n=5).collect():
        got.setdefault(r.user_id, []).append((r["rank"], r.movie_id))
    for u in users:
        assert [m for _, m in sorted(got.get(u, []))] == naive_recommend(x, x, movies, u, 5, 3)


def test_recommend_edges(spark):
    # user 1 rated movie 1 only; neighbour 2 rated movie 2 low -> unsupported 3.0 wins
    rows = [(1, 1, 5.0), (2, 1, 5.0), (2, 2, 1.0), (3, 3, 4.0), (3, 4, 4.0)]
    cells = spark.createDataFrame(rows, SCHEMA)
    nbrs = Fe.similar_users(cells, 5)
    recs = knn.recommend(cells, nbrs, cells, 5, n=3).where("user_id = 1").orderBy("rank").collect()
    assert [(r.movie_id, r.predicted_rating) for r in recs] == [(3, 3.0), (4, 3.0), (2, 1.0)]
    req = spark.createDataFrame([(1, 1), (424242, 5)], "user_id long, n int")
    out = knn.recommend(cells, nbrs, cells, 5, n=50, requests=req).collect()
    assert [(r.user_id, r.movie_id) for r in out] == [(1, 3)]


def naive_zero_fill(x, users, u, m, k):
    others = sorted(((-cos(x[u], x[v]), v) for v in users if v != u))
    nb = [u] + [v for _, v in others][:k - 1]
    return sum(x[v].get(m, 0.0) for v in nb) / k


def test_zero_fill_matches_naive(spark):
    rows = sample_rows(4, n_users=12, n_movies=10, density=0.15)
    cells = spark.createDataFrame(rows, SCHEMA)
    users, movies, x = dense(rows)
    req_rows = [(i, u, m) for i, (u, m) in enumerate([(u, m) for u in users[:6] for m in movies[:5]])]
    req_rows += [(1000, 999, movies[0]), (1001, users[0], 999)]
    req = spark.createDataFrame(req_rows, "event_id long, user_id long, movie_id long")
    got = {r.event_id: r.predicted_rating for r in knn.predict_zero_fill(req, cells).collect()}
    assert 1000 not in got and 1001 not in got
    k = min(5, len(users))
    for i, u, m in req_rows[:-2]:
        assert got[i] == pytest.approx(naive_zero_fill(x, users, u, m, k), abs=1e-12)


def naive_user_knn(x, train_users, test_users, y, k):
    k = min(k, len(train_users))
    out = {}
    for u in test_users:
        order = sorted(((-cos(x[u], x[v]), v) for v in train_users))
        out[u] = sum(y[v] for _, v in order[:k]) / k
    return out


def test_user_level_knn_with_padding(spark):
    rows = sample_rows(5, n_users=40, n_movies=30, density=0.05)
    cells = spark.createDataFrame(rows, SCHEMA)
    users, _, x = dense(rows)
    split = S.split_users(cells)
    sp = {r.user_id: r.split for r in split.collect()}
    tr = [u for u in users if sp[u] == "train"]
    te = [u for u in users if sp[u] == "val"]
    y = {u: float(np.mean(list(x[u].values()))) for u in users}
    got = {(r.k, r.user_id): r.prediction
           for r in knn.user_knn_predict(cells, cells, split, (3, 5)).collect()}
    for k in (3, 5):
        want = naive_user_knn(x, tr, te, y, k)
        for u in te:
            assert got[(k, u)] == pytest.approx(want[u], abs=1e-9)


def test_tune_k_matches_individual_runs(spark):
    rows = sample_rows(6)
    cells = spark.createDataFrame(rows, SCHEMA)
    s = S.split_rows(cells.withColumn("timestamp", F.lit(0)))
    train, val = S.side(s, "train"), S.side(s, "val")
    nbrs = Fe.similar_users(cells, 10)
    res = {r.k: (r.rmse, r.mae) for r in T.tune_k(val, nbrs, train, (3, 5, 10)).collect()}
    for k in (3, 5, 10):
        p = knn.predict(val, nbrs, train, k)
        e = p.select((F.col("prediction") - F.col("rating")).alias("e"))
        m = e.agg(F.sqrt(F.avg(F.col("e") ** 2)).alias("rmse"), F.avg(F.abs("e")).alias("mae")).first()
        assert res[k] == pytest.approx((m.rmse, m.mae), abs=1e-12)


def test_best_k_first_on_ties(spark):
    df = spark.createDataFrame([(0, 3, 1.0, 0.5), (1, 5, 0.9, 0.4), (2, 10, 0.9, 0.3)],
                               "position int, k int, rmse double, mae double")
    assert T.best_k(df, "rmse").first().k == 5
    assert T.best_k(df, "mae").first().k == 10
    close = spark.createDataFrame([(0, 3, 0.9 + 1e-8, 0.5), (1, 5, 0.9, 0.5)], df.schema)
    assert T.best_k(close, "rmse").first().k == 5          # decided on full values
    with pytest.raises(ValueError):
        T.best_k(df, "accuracy")


def test_split_rows_exact_size(spark):
    rows = sample_rows(8)
    df = spark.createDataFrame(rows, SCHEMA)
    s = S.split_rows_exact(df)
    assert s.where("split = 'train'").count() == int(0.8 * len(rows))
    assert s.count() == len(rows)


def test_sweep_failed_k_left_out(spark):
    rows = sample_rows(9, n_users=30)
    cells = spark.createDataFrame(rows, SCHEMA)
    sw = T.sweep_k(cells, cells, S.split_users(cells), (0, 3, 5))
    got = {r.k: r for r in sw.collect()}
    assert got[0].status == "failed" and got[0].rmse is None
    assert got[3].status == "completed" and got[3].position == 1
    assert T.best_k(sw, "rmse").first().k in (3, 5)
    lb = T.leaderboard(T.runs_from_sweep(sw)).orderBy("leaderboard_rank").collect()
    assert lb[-1].k_value == 0 and lb[-1].status == "FAILED"
