"""A top-k on the join route by parts of the users: same rows, less on disk at a time."""

import io
import os
import re
from contextlib import redirect_stdout

import pytest

from cinerank.functions import ranking
from cinerank.operators import features as Fe
from cinerank.operators import similarity as Sim
from test_similarity_scale import SCHEMA, dense_rows


def shuffle_files(spark):
    top = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    return [f for d in top for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_") and f.endswith(".data")]


@pytest.mark.parametrize("chunk", [2, 1024])
def test_parts_have_the_rows_of_the_whole(spark, monkeypatch, chunk):
    monkeypatch.setattr(Sim, "CHUNK_RATERS", chunk)
    cells = spark.createDataFrame([*dense_rows(80, 60, 5, 0.12), (500, 1, 3.0), (501, 999, 2.0)], SCHEMA)
    plain = Sim.Layout(True, pairs=900.0)
    want = sorted(map(tuple, Sim.cosine_similarity(cells, top_k=4, layout=plain).collect()))
    candidates = sorted(map(tuple, Sim.candidate_pairs(cells, 4, plain).collect()))
    monkeypatch.setattr(Sim, "PASS_PAIRS", 600)
    assert Sim._passes(plain.pairs) == 3
    for floors in (False, True):
        got = Sim.cosine_similarity(cells, top_k=4, layout=Sim.Layout(True, floors=floors, pairs=900.0))
        assert sorted(map(tuple, got.collect())) == want
    assert sorted(map(tuple, Sim.candidate_pairs(cells, 4, plain).collect())) == candidates


def test_a_stage_table_leaves_no_shuffle_files(spark):
    """They would lie there until the driver's next full collection of garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, conf = set(shuffle_files(spark)), spark.conf.get(key, None)
    df = ranking.reliable_checkpoint(spark.range(20000).groupBy((Fe.F.col("id") % 5000).alias("k")).count())
    assert df.count() == 5000 and spark.conf.get(key, None) == conf
    stay = set(shuffle_files(spark)) - before
    assert len(stay) <= 1, stay                   # of the count itself


def test_all_pairs_are_not_collected_before_they_are_moved(spark):
    """A table of pairs that hardly repeat only spills: pairs go straight to where they are summed."""
    cells = spark.createDataFrame(dense_rows(60, 80, 5, 0.1), SCHEMA)
    buf = io.StringIO()
    with redirect_stdout(buf):
        Sim.cosine_similarity(cells, layout=Sim.Layout(True, pairs=9.0 * Sim.TASK_PAIRS)).explain()
    plan = buf.getvalue()
    moved = re.findall(r"Exchange hashpartitioning\(_ua[^)]*, _ub[^)]*\), \w+", plan)
    assert len(moved) == 1 and moved[0].endswith("BY_NUM") and ", 9)" in moved[0], moved
    below = plan[plan.index(moved[0]) + len(moved[0]):]
    assert "HashAggregate(keys=[_ua" not in below
