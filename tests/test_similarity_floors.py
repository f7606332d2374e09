"""Top-k with floors on the join route."""

import io
import re
from contextlib import redirect_stdout

from cinerank.operators import features as Fe
from cinerank.operators import similarity as Sim
from test_similarity_scale import SCHEMA, dense_rows


def test_join_with_floors_moves_pairs_once(spark):
    rows = dense_rows(60, 80, 5, 0.1)
    cells = spark.createDataFrame(rows, SCHEMA)
    full = sorted(map(tuple, Sim.cosine_similarity(cells, top_k=4, layout=Sim.Layout(True)).collect()))
    cut = Sim.cosine_similarity(cells, top_k=4, layout=Sim.Layout(True, floors=True, pairs=5.0 * Sim.TASK_PAIRS))
    buf = io.StringIO()
    with redirect_stdout(buf):
        cut.explain()
    moved = re.findall(r"Exchange hashpartitioning\((?:_ua|_ub|neighbor_id)[^)]*\), \w+", buf.getvalue())
    assert len(moved) == 2 and all("_ub" not in m and m.endswith("BY_NUM") for m in moved), moved     # pairs; norms and floors
    assert sorted(map(tuple, cut.collect())) == full
    pairs = [sorted(map(tuple, Sim.candidate_pairs(cells, 4, x).collect())) for x in (Sim.Layout(True), Sim.Layout(False, 3, 3))]
    assert pairs[0] == pairs[1] and len(pairs[0]) < Sim.cosine_similarity(cells).count()


def test_pruned_follows_the_cheaper_route(spark, monkeypatch):
    """On a sparse catalogue the pairs are joined: a grid would copy every rating per block."""
    cells = spark.createDataFrame([(u, (u * 7 + j * 13) % 900, 1.0 + (u + j) % 9 / 2) for u in range(600) for j in range(3)], SCHEMA)
    assert Sim.plan_layout(spark, cells, None).join
    monkeypatch.setattr(Sim, "_gridded", None)
    got = sorted(map(tuple, Fe.similar_users_pruned(cells, 3).collect()))
    assert got and got == sorted(map(tuple, Fe.similar_users(cells, 3).collect()))
