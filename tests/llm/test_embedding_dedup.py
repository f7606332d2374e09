import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.llm import embedding_dedup as ed
from cinerank.llm.embedding_dedup import embedding_dedup, find_balls, fit_index, op13_embedding_dedup, unit_rows


def brute(ids, vectors, threshold=0.9):
    """(id, links, component, kept) by comparing all pairs."""
    good = [k for k, v in enumerate(vectors) if v is not None and len(v) and all(e is not None and np.isfinite(e) for e in v) and any(v)]
    x = unit_rows(np.array([vectors[k] for k in good])) if good else np.zeros((0, 1))
    link = np.eye(len(vectors), dtype=bool)
    for a, k in enumerate(good):
        link[k, good] = x[a] @ x.T >= threshold
        link[k, k] = True
    link |= link.T
    part = np.arange(len(vectors))
    while True:
        new = np.array([part[row].min() for row in link])
        if (new == part).all():
            break
        part = new
    low = {p: min((ids[k] for k in np.flatnonzero(part == p) if ids[k] is not None), default=None) for p in set(part.tolist())}
    return sorted(((i, int(link[k].sum()) - 1, low[part[k]], i == low[part[k]]) for k, i in enumerate(ids)), key=repr)


def result(df):
    return sorted(map(tuple, df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def planted(n, d, groups, size, rng, spread=0.02):
    """Random unit vectors, and groups of near copies of some."""
    x = rng.standard_normal((n, d))
    near = [x[g] / np.linalg.norm(x[g]) + rng.standard_normal((size, d)) * spread for g in range(groups)]
    return unit_rows(np.concatenate([x, *near]))


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if e is None else float(e) for e in v]) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0, 0], [2, 0.1, 0], [0, 0, 0], None, [], [1, None, 0], [nan, 1, 1], [inf, 1, 1], [1, 0], [1e300, 0, 0], [0, 1e-300, 0],
               [0, 3, 0], [0, 3, 0], [1, 0, 0], [0, 0, -5], [-1, 0, 0], [0, 0, 5]]
    ids = [5, 6, 7, 8, 9, 10, 11, 12, 13, 3, None, 20, 21, 5, None, 30, 31]
    df = table(spark, vectors, ids)
    for c in ("c", "w", "v", "id", "place", "unit", "node", "links", "low", "kept", "_h", "_n"):
        df = df.withColumn(c, F.lit("clash"))
    shorter = [None if v is not None and len(v) == 2 else v for v in vectors]
    assert result(embedding_dedup(df)) == brute(ids, shorter)
    assert embedding_dedup(df.where("vec_id < 0")).count() == 0
    assert result(embedding_dedup(df.where("vec_id = 8"))) == [(8, 0, 8, True)]


@pytest.mark.parametrize("unit", [16_384, 150])
def test_groups(spark, unit, monkeypatch):
    """A hot group in a ball, a hot group too wide for one, small groups, and cells
    and balls that are dealt over several units."""
    monkeypatch.setattr(ed, "UNIT", unit)
    rng = np.random.default_rng(4)
    x = planted(900, 16, 25, 4, rng)
    tight = unit_rows(np.eye(16)[:1] + rng.standard_normal((400, 16)) * 0.02)
    wide = unit_rows(np.eye(16)[1:2] + rng.standard_normal((300, 16)) * 0.08)
    vectors = list(np.concatenate([x, tight, wide, tight[:200], np.repeat(x[:1], 300, axis=0)]))
    order = rng.permutation(len(vectors))
    vectors = [vectors[k] for k in order]
    got, want = result(embedding_dedup(table(spark, vectors), recall=0.999)), brute(range(len(vectors)), vectors)
    assert [g[0] for g in got] == [w[0] for w in want]
    links, found = sum(w[1] for w in want), sum(g[1] for g in got)
    assert 0.999 * links <= found <= links
    assert sum(g != w for g, w in zip(got, want)) <= 5


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, the hardest ones: measured against brute
    force, and nothing below it."""
    rng = np.random.default_rng(8)
    x = unit_rows(rng.standard_normal((3000, 32)))
    side = rng.standard_normal((3000, 32))
    side -= (side * x).sum(1, keepdims=True) * x
    y = 0.901 * x + np.sqrt(1 - 0.901 ** 2) * unit_rows(side)
    vectors = list(np.concatenate([x, y]))
    got, want = result(embedding_dedup(table(spark, vectors))), brute(range(6000), vectors)
    found, links = sum(g[1] for g in got), sum(w[1] for w in want)
    assert 0.93 * links <= found <= links


def test_query(spark):
    """check_s has planted groups of near copies."""
    import os
    from tests.conftest import SF_MEDIUM
    for folder in (SF_MEDIUM, "/root/testdata/check_s"):
        if not os.path.exists(folder):
            continue
        rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
        x = unit_rows(np.array(rows.embedding.tolist()))
        want = np.array([(x[i:i + 500] @ x.T >= 0.9).sum(1) - 1 for i in range(0, len(x), 500)], dtype=object)
        want = dict(zip(rows.vec_id, np.concatenate(list(want)).astype(int)))
        got = op13_embedding_dedup(spark, folder).toPandas()
        assert len(got) == len(rows) and sorted(got.vec_id) == sorted(rows.vec_id)
        found = sum(got.n_links)
        assert 0.99 * sum(want.values()) <= found <= sum(want.values())
        assert (got.n_links <= got.vec_id.map(want)).all() and (got.kept == (got.vec_id == got.component_id)).all()


def test_fit():
    rng = np.random.default_rng(1)
    x = unit_rows(np.concatenate([rng.standard_normal((500, 8)), np.ones((100, 8)) + rng.standard_normal((100, 8)) * 0.01]))
    pivots = find_balls(x, 0.95)
    assert len(pivots) >= 1 and (pivots[0] @ x[500:].T > 0.99).all()
    index = fit_index(x, 10_000, 0.95, 0.9)
    place = index.place(x)
    assert (place[500:] >= index.cells).all() and (place[:400] < index.cells).mean() > 0.9
    assert fit_index(x[:3], 3, 0.9, 0.9).cells == 1
