"""All pairs in packed runs: the rows and bits of the plain ones, in a fraction of the disk."""

import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from cinerank.operators import features as Fe
from cinerank.operators import pairs
from cinerank.operators import similarity as Sim
from cinerank.plans import workflows as W
from cinerank.sources import store
from test_similarity_scale import SCHEMA, dense_rows


def stored_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)


def rows_of(df):
    return sorted(map(tuple, df.select("user_id", "neighbor_id", "similarity").collect()))


@pytest.mark.parametrize("blocks", [1, 4])
@pytest.mark.parametrize("rows", [dense_rows(70, 40, 2), dense_rows(70, 300, 3, 0.05), dense_rows(60, 900, 4, 0.004),
                                  [(u, m, r + u % 9 / 7) for u, m, r in dense_rows(50, 30, 5, 0.4, 2 ** 40)]],
                         ids=["dense", "sparse", "few pairs", "averages and large ids"])
def test_packed_runs_have_the_bits_of_the_rows(spark, blocks, rows):
    cells = spark.createDataFrame(rows, SCHEMA)
    want = rows_of(Sim.cosine_similarity(cells, layout=Sim.Layout(True)))
    sims = Sim.cosine_similarity(cells, layout=Sim.Layout(False, blocks, blocks))
    assert want and rows_of(sims) == want
    assert rows_of(pairs.pairs_of(sims.packed_runs)) == want
    some = sorted({u for u, _, _ in rows})[3:50:9] + [-5]
    assert rows_of(pairs.pairs_of(sims.packed_runs, some)) == [r for r in want if r[0] in some]
    met = [(r.user_id, v) for r in sims.packed_runs.collect() for v in r.neighbors if r.both]
    assert len(met) == len({frozenset(p) for p in met})             # two blocks meet once


@pytest.mark.parametrize("limits", [{"DENSE_FLOPS": 0}, {"TILE_ROWS": 7, "TILE_COLUMNS": 33}, {"DENSE_CELL": 500}])
def test_runs_of_any_tiles(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(Sim, name, value)
    x = np.array(dense_rows(40, 25, 6))
    q = (x[:, 2] * Sim.SCALE).astype(np.int64)
    block = Sim._pack_block(pd.DataFrame({"_b": 0, "user_id": x[:, 0].astype(np.int64), "movie_id": x[:, 1].astype(np.int64), "_q": q, "_f": 0.0})).iloc[0]
    batch = pa.RecordBatch.from_pylist([{"t": 0, "s": s, **block} for s in (0, 1)])
    tiles = pa.Table.from_batches(list(Sim._packed_kernel()([batch]))).to_pylist()
    got = rows_of(pairs.pairs_of(spark.createDataFrame(tiles, pairs.RUN_SCHEMA)))
    want = sorted(zip(*(c.to_pylist() for c in pa.Table.from_batches(list(Sim._grid_kernel(True, None)([batch]))).columns)))
    assert got == want


def test_a_stored_similarity_takes_little_disk(spark, tmp_dir):
    """Plain rows take 8 bytes a pair at least (a similarity is a double)."""
    cells = spark.createDataFrame(dense_rows(1500, 60), SCHEMA)
    sims = Fe.user_similarity(cells)
    store.save_features(cells, sims, f"{tmp_dir}/fs")
    back = store.load_similarity(f"{tmp_dir}/fs", spark)
    assert back.dtypes == sims.dtypes
    assert stored_bytes(f"{tmp_dir}/fs/similarity") < 1.5 * sims.count()
    assert sims.exceptAll(back).isEmpty() and back.exceptAll(sims).isEmpty()


def test_other_similarities_are_stored_as_they_are(spark, tmp_dir):
    cells = spark.createDataFrame(dense_rows(60, 20), SCHEMA)
    some = Sim.cosine_similarity(cells, layout=Sim.Layout(False, 2, 2)).where("user_id < 9")
    odd = spark.createDataFrame([(1, None, 0.5), (None, 2, None)], some.schema)
    for i, sims in enumerate((some, odd, Sim.cosine_similarity(cells, layout=Sim.Layout(True)), Sim.cosine_similarity(cells, top_k=3))):
        store.save_features(cells, sims, f"{tmp_dir}/fs{i}")
        assert sorted(map(str, store.load_similarity(f"{tmp_dir}/fs{i}", spark).collect())) == sorted(map(str, sims.collect()))
        assert store.load_similarity(f"{tmp_dir}/fs{i}", spark, [2]).where("user_id <> 2").isEmpty()


def test_lookups_from_packed_pairs(spark, tmp_dir):
    rows = [(u, m, r, 1) for u, m, r in dense_rows(1200, 30, 8, first=1)]
    ratings = spark.createDataFrame(rows, SCHEMA + ", timestamp long")
    _, sims, _, lookups = W.prepare_features(ratings, f"{tmp_dir}/features", n_lookup=3)
    assert stored_bytes(f"{tmp_dir}/features/similarity") < 1.5 * sims.count()
    _, plain, _, want = W.prepare_features(ratings, None, n_lookup=3)
    assert sorted(map(tuple, lookups.collect())) == sorted(map(tuple, want.collect()))
    assert sims.count() == plain.count()
