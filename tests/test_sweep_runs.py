"""The reference's sweep tests, on the run table: one result per K with the
expected keys, metrics in range, a positive time, best K among those tried."""

import os
import time

from cinerank.operators import split as S, tuning as T
from cinerank.plans import context as C

SF = "/root/testdata/sf0.001"


def test_sweep_runs_and_best(spark, tmp_dir):
    cells = C.r1_cells(spark, SF)
    t0 = time.perf_counter()
    rows = [r.asDict() for r in T.sweep_k(cells, cells, S.split_users(cells), (3, 5)).collect()]
    seconds = time.perf_counter() - t0
    assert sorted(r["k"] for r in rows) == [3, 5]
    for r in rows:
        assert {"rmse", "mae", "coverage", "status"} <= set(r)
        assert r["rmse"] >= 0 and 0 <= r["coverage"] <= 1
    log = T.RunLog(spark, os.path.join(tmp_dir, "runs"))
    ids = T.log_sweep(log, rows, "sweep_test", seconds)
    cmp = log.comparison("sweep_test").collect()
    assert {r.run_id for r in cmp} == set(ids)
    assert all(r.training_time > 0 for r in cmp)
    sw = T.sweep_k(cells, cells, S.split_users(cells), (3, 5, 10))
    best = T.best_k(sw, "rmse").first()
    assert best.k in (3, 5, 10) and best.rmse is not None
