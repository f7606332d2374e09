"""F11's sample lookups rank the pairs of the looked-up users alone."""

import io
from contextlib import redirect_stdout

from cinerank.plans import workflows as W


def test_lookups_rank_only_the_users_asked(spark, tmp_dir):
    rows = [(u, m, 1.0 + (u * m) % 8 / 2, 1) for u in range(1, 31) for m in range(1, 7) if (u + m) % 3]
    ratings = spark.createDataFrame(rows, "user_id long, movie_id long, rating double, timestamp long")
    _, sims, _, lookups = W.prepare_features(ratings, f"{tmp_dir}/features", n_lookup=3)
    buf = io.StringIO()
    with redirect_stdout(buf):
        lookups.explain()
    plan = buf.getvalue()
    assert plan.index("Window") < plan.index("LeftSemi")        # the semi-join lies below
    best = {}
    for r in sims.collect():
        best.setdefault(r.user_id, []).append((-r.similarity, r.neighbor_id))
    got = sorted((r.user_id, r["rank"], r.neighbor_id) for r in lookups.collect())
    assert got == [(u, i + 1, v) for u in (1, 2, 3) for i, (_, v) in enumerate(sorted(best[u])[:3])]
