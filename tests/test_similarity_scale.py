"""The grid's kernel on packed blocks and the join with floors: same rows, bounded work."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from cinerank.operators import similarity as Sim

SCHEMA = "user_id long, movie_id long, rating double"


def dense_rows(users, movies, seed=1, density=0.5, first=0):
    rng = np.random.default_rng(seed)
    x = (rng.random((users, movies)) < density) * rng.integers(1, 11, (users, movies)) / 2
    u, m = np.nonzero(x)
    return list(zip((u + first).tolist(), m.tolist(), x[u, m].tolist()))


def packed(rows, number, side, task=0):
    u, m, r = zip(*rows)
    q = (np.array(r) * Sim.SCALE).astype(np.int64)
    block = Sim._pack_block(pd.DataFrame({"_b": number, "user_id": u, "movie_id": m, "_q": q, "_f": 0.0})).iloc[0]
    return {"t": task, "s": side, **block}


def test_a_block_meets_all_in_bounded_memory():
    """Of 3,000 x 3,000 similarities (72 MB as doubles) a task holds tiles and the k best."""
    rows = dense_rows(3000, 40)
    batch = pa.RecordBatch.from_pylist([packed(rows, 0, 0), packed(rows, 0, 1)])
    tracemalloc.start()
    try:
        out = pa.Table.from_batches(list(Sim._grid_kernel(True, 5)([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert out.num_rows == 15000 and peak < 50 << 20


@pytest.mark.parametrize("values", [1.0, 0.654321])
def test_top_k_of_packed_blocks_with_ties(spark, values):
    """Many equal vectors: the smallest ids of those that tie, on every route."""
    rows = [(u + 50 * c, m, r * values + (m % 3) * (values - 1)** 2) for u, m, r in dense_rows(50, 12, 3) for c in range(4)]
    cells = spark.createDataFrame(rows, SCHEMA)
    got = [sorted(map(tuple, Sim.cosine_similarity(cells, top_k=6, layout=x).collect()))
           for x in (Sim.Layout(True), Sim.Layout(False, 1, 1), Sim.Layout(False, 5, 5), Sim.Layout(False, 2, 2, floors=True))]
    assert got[0] and all(g == got[0] for g in got)


def test_packed_numbers():
    for values in ([], [0, 255], [-1, 255], [2 ** 40, -3], [2 ** 63 - 1, 0]):
        assert Sim._unpack(Sim._pack(np.array(values, np.int64))).tolist() == values
    assert len(Sim._pack(np.arange(200))) == 201


def test_blocks_do_not_follow_the_users(spark):
    """Copies of a rating: one a left block, and blocks are as many as there are cores to
    fill, so what is moved grows with the ratings."""
    few, many = (Sim.plan_layout(spark, spark.createDataFrame([(u, m, 3.0) for u in range(n) for m in range(12)], SCHEMA), None)
                 for n in (5_000, 10_000))
    assert not few.join and not many.join and few.left_blocks == many.left_blocks


def test_only_pairs_that_may_count_are_multiplied_exactly():
    """Of 4,000 x 4,000 pairs a top-5 passes on a few a user; sums past 2^24 keep their bits."""
    for rows in (dense_rows(4000, 40), [(u, m, r + m / 7e5) for u, m, r in dense_rows(4000, 40)]):
        a, b = (Sim._Block(0, *(packed(part, 0, 0)[c] for c in ("users", "sizes", "movies", "q", "floors"))) for part in (rows, rows[::-1]))
        floor, looked, best = np.zeros(a.n), 0, []
        for li, ri, dot in Sim._near_tiles(a, b, b.codes_in(a), True, floor, 5):
            looked += len(li)
            sim = dot / (a.norms[li] * b.norms[ri])
            best = [Sim._cut([*best, (li, b.users[ri], sim)], floor, 5)]
        assert looked < 60 * a.n
        x = np.zeros((a.n, 40), np.int64)
        x[a.of, a.movies] = a.q
        for u in range(0, a.n, 997):
            sim = (x @ x[u]) / (a.norms[u] * a.norms)
            sim[u] = 0
            want = np.lexsort((a.users, -sim))[:5]
            own = best[0][0] == u
            assert (best[0][1][own] == a.users[want]).all() and (best[0][2][own] == sim[want]).all()
