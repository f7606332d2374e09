"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries",
"sf", ...}.  Each query is executed to completion with a no-op sink (all
rows produced, nothing collected) after one warm-up query at sf0.001.  The
headline list runs $BENCH_REPEATS times (default 2); "queries" holds each
query's best run and "value" their sum, "first_run_total" the first pass.
Nothing is cached between runs: every run rebuilds its plans and writes new
stage tables.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cinerank.operators import features as Fe  # noqa: E402
from cinerank.plans import context as C  # noqa: E402
from cinerank.plans import queries as Q  # noqa: E402
from cinerank.session import build_session  # noqa: E402

HEADLINE = [
    "recommend_all",          # flagship: ratings -> cosine -> K-NN -> top-5 per user
    "user_similarity",        # exact all-pairs cosine on R2 (orders x lineitem)
    "similar_users",          # top-5 neighbours on R2
    "knn_predict",            # validation predictions
    "tune_k",                 # all K in one job
    "sweep_k",                # user-level K-NN sweep
    "predict_batch",          # batch prediction of every event pair
    "ingest_strict",          # dedup -> coerce -> validate
    "validation_report",
    "rating_metrics",
    "evaluation_report",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    only = sys.argv[1:]
    spark = build_session()
    # Warm-up (JIT, Python workers) on the smallest fixture; not timed.
    run(Q.QUERIES["recommend_all"](spark, os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    runs: dict[str, list[float]] = {}
    for _ in range(repeats):
        for name in HEADLINE:
            if only and name not in only:
                continue
            spark.sparkContext.setJobGroup(name, name)
            t0 = time.perf_counter()
            run(Q.QUERIES[name](spark, sf_dir))      # plans and stage tables rebuilt each run
            runs.setdefault(name, []).append(round(time.perf_counter() - t0, 3))
    times = {name: min(ts) for name, ts in runs.items()}
    # top-20 neighbours per user (R1 = events, R2 = orders x lineitem).
    probes = {}
    if not only:
        for name, cells_of in (("r1_top20", C.r1_cells), ("r2_top20", C.r2_cells)):
            t0 = time.perf_counter()
            run(Fe.similar_users(cells_of(spark, sf_dir), 20))
            probes[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "repeats": repeats,
        "first_run_total": round(sum(ts[0] for ts in runs.values()), 3),
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(os.environ.get("BENCH_CPUS", "8")),
        "baseline_probes": probes,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
