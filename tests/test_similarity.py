"""Features and the block cosine engine, checked against brute force."""

import math

import numpy as np
import pytest

from cinerank.operators import features as Fe
from cinerank.operators import similarity as Sim


def brute_cosine(rows):
    users = sorted({u for u, _, _ in rows})
    movies = sorted({m for _, m, _ in rows})
    ui = {u: i for i, u in enumerate(users)}
    mi = {m: i for i, m in enumerate(movies)}
    x = np.zeros((len(users), len(movies)))
    for u, m, r in rows:
        x[ui[u], mi[m]] = r
    out = {}
    for a in users:
        for b in users:
            if a == b:
                continue
            va, vb = x[ui[a]], x[ui[b]]
            dot = float(va @ vb)
            if dot > 0:
                out[(a, b)] = dot / (math.sqrt(va @ va) * math.sqrt(vb @ vb))
    return out


def random_cells(seed, n_users=40, n_movies=25, density=0.15, hot_movie=True):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(1, n_users + 1):
        for m in range(1, n_movies + 1):
            if rng.random() < density or (hot_movie and m == 1 and rng.random() < 0.6):
                rows.append((u, m, float(rng.integers(1, 11)) / 2))
    return rows


def test_docstring_pair(spark):
    cells = spark.createDataFrame([(1, 10, 5.0), (1, 11, 4.0), (2, 10, 4.0)],
                                  "user_id long, movie_id long, rating double")
    sims = {(r.user_id, r.neighbor_id): r.similarity for r in Fe.user_similarity(cells).collect()}
    assert sims[(1, 2)] == pytest.approx(20 / (math.sqrt(41) * 4), abs=1e-12)
    assert sims[(1, 2)] == sims[(2, 1)]


@pytest.mark.parametrize("blocks", [1, 2, 3, 5])
def test_block_product_equals_brute_force(spark, blocks):
    rows = random_cells(blocks)
    cells = spark.createDataFrame(rows, "user_id long, movie_id long, rating double")
    got = {(r.user_id, r.neighbor_id): r.similarity
           for r in Sim.cosine_similarity(cells, layout=Sim.Layout(False, blocks, blocks)).collect()}
    want = brute_cosine(rows)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-12)
        assert 0 < got[k] <= 1 + 1e-12
    assert all(a != b for a, b in got)


@pytest.mark.parametrize("blocks", [1, 4])
def test_top_k_pruned_in_cells_is_exact(spark, blocks):
    rows = random_cells(7 + blocks, n_users=30)
    cells = spark.createDataFrame(rows, "user_id long, movie_id long, rating double")
    got = {}
    for r in Sim.cosine_similarity(cells, top_k=3, layout=Sim.Layout(False, blocks, blocks)).collect():
        got.setdefault(r.user_id, []).append((r["rank"], r.neighbor_id))
    want = brute_cosine(rows)
    for u in got:
        cand = sorted(((-s, b) for (a, b), s in want.items() if a == u))[:3]
        assert [b for _, b in sorted(got[u])] == [b for _, b in cand]


def test_bipartite(spark):
    rows = random_cells(11, n_users=20)
    left = [r for r in rows if r[0] <= 8]
    right = [r for r in rows if r[0] > 8]
    s = "user_id long, movie_id long, rating double"
    got = {(r.user_id, r.neighbor_id): r.similarity for r in Sim.cosine_similarity(
        spark.createDataFrame(left, s), spark.createDataFrame(right, s), layout=Sim.Layout(False, 3, 2)).collect()}
    want = {k: v for k, v in brute_cosine(rows).items() if k[0] <= 8 < k[1]}
    assert got.keys() == want.keys()


def test_duplicate_cells_average_and_zero_dropped(spark):
    df = spark.createDataFrame([(1, 1, 5.0, 0), (1, 1, 4.0, 0), (1, 2, 0.0, 0)],
                               "user_id long, movie_id long, rating double, timestamp long")
    cells = Fe.rating_cells(df).collect()
    assert [(c.user_id, c.movie_id, c.rating) for c in cells] == [(1, 1, 4.5)]


def test_no_co_raters_no_neighbours(spark):
    cells = spark.createDataFrame([(9, 99, 4.0), (1, 1, 3.0), (2, 1, 2.0)],
                                  "user_id long, movie_id long, rating double")
    assert Fe.similar_users(cells, 5).where("user_id = 9").count() == 0
    with pytest.raises(ValueError):
        Fe.similar_users(cells, 0)


def test_matrix_exports(spark):
    cells = spark.createDataFrame([(1, 10, 4.0), (2, 20, 2.0), (2, 10, 1.0)],
                                  "user_id long, movie_id long, rating double")
    wide = {r.user_id: r.asDict() for r in Fe.rating_matrix(cells).collect()}
    assert wide[1]["20"] == 0.0 and wide[2]["10"] == 1.0
    vec = {r.user_id: r.ratings for r in Fe.user_vectors(cells).collect()}
    assert vec == {1: [4.0, 0.0], 2: [1.0, 2.0]}
    d = Fe.matrix_density(cells).first()
    assert (d.n_users, d.n_movies, d.n_ratings, d.density) == (2, 2, 3, 0.75)
    idx = {r.movie_id: r.movie_idx for r in Fe.movie_index(cells).collect()}
    assert idx == {10: 0, 20: 1}
    st = Fe.rating_stats(cells).first()
    assert (st.min_rating, st.max_rating, st.n_rated) == (1.0, 4.0, 3)
    assert st.std_rating == pytest.approx(np.std([4.0, 2.0, 1.0]), abs=1e-6)


def test_full_similarity_has_diagonal(spark):
    cells = spark.createDataFrame([(1, 1, 3.0), (2, 1, 2.0), (3, 2, 5.0)],
                                  "user_id long, movie_id long, rating double")
    full = {(r.user_id, r.neighbor_id): r.similarity for r in Fe.user_similarity_full(cells).collect()}
    assert full[(3, 3)] == 1.0 and full[(1, 2)] == pytest.approx(1.0)
    assert (1, 3) not in full


ROUTES = [Sim.Layout(True), Sim.Layout(False, 1, 1), Sim.Layout(False, 4, 4)]


@pytest.mark.parametrize("chunk", [2, 1024])
@pytest.mark.parametrize("grid", [0, 1])
def test_every_route_gives_the_same_bits(spark, monkeypatch, chunk, grid):
    """Averaged ratings lie off the half-star grid; sums of integers don't care."""
    monkeypatch.setattr(Sim, "CHUNK_RATERS", chunk)
    monkeypatch.setattr(Sim, "PAIR_CHUNK", 64 if grid else 1 << 20)
    rng = np.random.default_rng(5)
    rows = [(u, m, r + float(rng.integers(0, 7)) / 7) for u, m, r in random_cells(21, n_users=59, n_movies=39, density=0.3)]
    cells = spark.createDataFrame(rows, "user_id long, movie_id long, rating double")
    got = [{(r.user_id, r.neighbor_id): r.similarity for r in Sim.cosine_similarity(cells, layout=x).collect()} for x in ROUTES]
    assert got[0] == got[1] == got[2]
    want = brute_cosine(rows)
    assert got[0].keys() == want.keys()
    assert all(got[0][k] == pytest.approx(v, abs=1e-6) for k, v in want.items())
    left, right = cells.where("user_id < 9"), cells.where("user_id >= 9")
    two = [{(r.user_id, r.neighbor_id): r.similarity for r in Sim.cosine_similarity(left, right, layout=x).collect()}
           for x in (Sim.Layout(True), Sim.Layout(False, 1, 5), Sim.Layout(False, 3, 2))]
    assert two[0] == two[1] == two[2] == {k: v for k, v in got[0].items() if k[0] < 9 <= k[1]}


@pytest.mark.parametrize("limits", [{}, {"DENSE_MATRIX": 0}, {"DENSE_MATRIX": 0, "DENSE_CELL": 0}, {"DENSE_FLOPS": 1e9}])
@pytest.mark.parametrize("scale", [500_000, 1, 10**9])
def test_block_dot_is_exact(monkeypatch, limits, scale):
    """Matrix product, array of sums, sorted sums; values past 2^53 in sum."""
    for name, value in limits.items():
        monkeypatch.setattr(Sim, name, value)
    monkeypatch.setattr(Sim, "PAIR_CHUNK", 50)
    rng = np.random.default_rng(3)
    x, y = ((rng.integers(0, 11, (n, 30)) * (rng.random((n, 30)) < 0.4)).astype(object) for n in (9, 12))
    odd = 0 if scale == 500_000 else 1                       # no common divisor
    x, y = (np.where(m > 0, m * scale + odd, 0) for m in (x, y))
    parts = []
    for m in (x, y):
        u, c = np.nonzero(m)
        parts += [u, c, np.array([int(v) for v in m[u, c]], np.int64), len(m)]
    li, ri, dot = Sim._block_dot(*parts)
    want = x.dot(y.T)
    got = np.zeros(want.shape, object)
    got[li, ri] = [int(d) for d in dot]
    assert (got == np.where(want < 2 ** 63, want, got)).all()


@pytest.mark.parametrize("head", [1, 4, 100])
def test_floors_keep_the_top_k(spark, monkeypatch, head):
    """A top-k with floors has the rows of the full route to the bit, from fewer pairs."""
    monkeypatch.setattr(Sim, "HEAD", head)
    cells = spark.createDataFrame(random_cells(31, n_users=80, n_movies=60, density=0.12), "user_id long, movie_id long, rating double")
    full = sorted(map(tuple, Sim.cosine_similarity(cells, top_k=4, layout=Sim.Layout(True)).collect()))
    cut = Sim.cosine_similarity(cells, top_k=4, layout=Sim.Layout(False, 5, 5, floors=True))
    assert sorted(map(tuple, cut.collect())) == full
    passed = Sim.candidate_pairs(cells, 4, Sim.Layout(False, 5, 5))
    pairs = {(r.user_id, r.neighbor_id): r.similarity for r in passed.collect()}
    assert all(pairs[r[0], r[1]] == r[2] for r in full)
    if head >= 4:
        assert len(pairs) < Sim.cosine_similarity(cells).count()
    floors = {r.user_id: r.floor for r in Sim.similarity_floors(cells.select("user_id", "movie_id", Sim.scaled(cells.rating).alias("_q")), 4).collect()}
    fourth = {r[0]: r[2] for r in full if r[3] == 4}
    assert floors and all(f <= fourth[u] for u, f in floors.items())


def test_layout_follows_the_counted_cost(spark):
    s = "user_id long, movie_id long, rating double"
    sparse = spark.createDataFrame([(u, u // 2, 3.0) for u in range(400)], s)
    dense = spark.createDataFrame([(u, m, 3.0) for u in range(3000) for m in range(3)], s).repartition(4)
    lay = lambda a, b=None: Sim.plan_layout(spark, a, b)
    assert lay(sparse).join and not lay(dense).join
    assert lay(dense.where("user_id = 7"), dense).join          # one user's request: every rating is read once
    assert lay(sparse.limit(0)).join


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 15), st.integers(1, 12),
                          st.integers(1, 10).map(lambda x: x / 2)),
                min_size=1, max_size=80, unique_by=lambda t: (t[0], t[1])),
       st.sampled_from([None, 1, 3]), st.sampled_from([None, 2]))
def test_property_product(spark, rows, blocks, top_k):
    cells = spark.createDataFrame(rows, "user_id long, movie_id long, rating double")
    got = Sim.cosine_similarity(
        cells, layout=Sim.Layout(blocks is None, blocks or 1, blocks or 1), top_k=top_k).collect()
    want = brute_cosine(rows)
    if top_k is None:
        assert {(r.user_id, r.neighbor_id) for r in got} == set(want)
    else:
        for u in {a for a, _ in want}:
            best = sorted(((-s, b) for (a, b), s in want.items() if a == u))[:top_k]
            mine = sorted((r["rank"], r.neighbor_id) for r in got if r.user_id == u)
            assert [b for _, b in mine] == [b for _, b in best]
    for r in got:
        assert r.similarity == pytest.approx(want[(r.user_id, r.neighbor_id)], abs=1e-12)


def test_similar_users_for_requests_and_single_vector(spark):
    rows = random_cells(51, n_users=20)
    cells = spark.createDataFrame(rows, "user_id long, movie_id long, rating double")
    req = spark.createDataFrame([(3,), (7,), (999,)], "user_id long")
    got = {}
    for r in Fe.similar_users_for(cells, req, 4).collect():
        got.setdefault(r.user_id, []).append((r["rank"], r.neighbor_id, r.similarity))
    full = {}
    for r in Fe.similar_users(cells, 4).collect():
        full.setdefault(r.user_id, []).append((r["rank"], r.neighbor_id, r.similarity))
    assert set(got) == {3, 7}
    for u in got:
        assert [(r, v) for r, v, _ in sorted(got[u])] == [(r, v) for r, v, _ in sorted(full[u])]
        assert [s for _, _, s in sorted(got[u])] == pytest.approx([s for _, _, s in sorted(full[u])])
    vec = Fe.user_vector(cells, 3)
    assert len(vec) == len({m for _, m, _ in rows})
    with pytest.raises(ValueError):
        Fe.user_vector(cells, 999)
    with pytest.raises(ValueError):
        Fe.similar_users_for(cells, req, 21, max_n=20)
