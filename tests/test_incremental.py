"""State per load: keyed merge, dictionaries, distinct counts, quantiles, run log,
quarantine, observed ingest, matrix blocks, point lookups."""

import glob
import hashlib
import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.operators import features as Fe
from cinerank.operators import incremental as I
from cinerank.operators import quality as Q
from cinerank.operators import tuning as T
from cinerank.plans import workflows as W
from cinerank.sources import commit, files, store
from cinerank.sources.merge import ConcurrentMerge, KeyedTable
from tests.test_similarity import random_cells

CELLS = "user_id long, movie_id long, rating double"
ROWS = CELLS + ", timestamp long, event_id long"


def content(folder):
    return {p: hashlib.md5(open(p, "rb").read()).hexdigest() for p in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


# --- keyed merge ---------------------------------------------------------------

def test_merge_equals_batch(spark, tmp_dir):
    rng = np.random.default_rng(1)
    rows = [(int(u), int(m), float(r), int(t), k) for k, (u, m, r, t) in enumerate(zip(
        rng.integers(1, 30, 900), rng.integers(1, 20, 900), rng.integers(1, 11, 900) / 2, rng.integers(0, 50, 900)))]
    rows += [(1, 1, 2.5, None, 901), (None, 1, 3.0, 5, 902), (None, 1, 4.0, 6, 903)]
    df = spark.createDataFrame(rows, ROWS)
    table = KeyedTable(spark, f"{tmp_dir}/t", order_cols=("timestamp", "event_id"), buckets=8)
    with pytest.raises(FileNotFoundError):
        table.read()
    for k in range(3):
        assert table.merge(f"load-{k}", df.where(F.col("event_id") % 3 == k))
    want = sorted(map(tuple, Q.dedup_latest(df, ("timestamp", "event_id")).collect()), key=repr)
    assert sorted(map(tuple, table.read().select(df.columns).collect()), key=repr) == want
    before, state = content(f"{tmp_dir}/t"), table.manifest()
    assert not table.merge("load-1", df.where(F.col("event_id") % 3 == 1))             # replayed
    assert table.manifest() == state and content(f"{tmp_dir}/t") == before
    assert not table.merge("load-1-again", df.where(F.col("event_id") % 3 == 1))       # nothing newer
    assert table.manifest()["folders"] == state["folders"] and content(f"{tmp_dir}/t") == before


def test_merge_touches_changed_buckets_only(spark, tmp_dir):
    table = KeyedTable(spark, f"{tmp_dir}/t", buckets=16)
    base = spark.range(400).select((F.col("id") % 40).alias("user_id"), F.col("id").alias("movie_id"), F.lit(3.0).alias("rating"), F.lit(10).cast("long").alias("timestamp"))
    table.merge("a", base)
    old, files_before = table.manifest()["folders"], content(f"{tmp_dir}/t")
    one = spark.createDataFrame([(0, 0, 5.0, 11), (1, 1, 1.0, 9)], CELLS + ", timestamp long")     # the second is older
    assert table.merge("b", one)
    new = table.manifest()["folders"]
    assert len([b for b in new if new[b] != old.get(b)]) == 1
    assert {p: h for p, h in content(f"{tmp_dir}/t").items() if p in files_before} == files_before
    got = {(r.user_id, r.movie_id): r.rating for r in table.read().collect()}
    assert got[0, 0] == 5.0 and got[1, 1] == 3.0 and len(got) == 400
    assert not table.merge("empty", base.limit(0)) and table.read().count() == 400


def test_merge_conflict(spark, tmp_dir, monkeypatch):
    """A second writer that commits the same version first: no change, try again."""
    table = KeyedTable(spark, f"{tmp_dir}/t", buckets=4)
    row = lambda r, t: spark.createDataFrame([(1, 1, r, t)], CELLS + ", timestamp long")
    table.merge("a", row(1.0, 1))
    stale = table.manifest()
    other = KeyedTable(spark, f"{tmp_dir}/t", buckets=4)
    other.merge("b", row(2.0, 2))
    monkeypatch.setattr(table, "manifest", lambda: stale)
    with pytest.raises(ConcurrentMerge):
        table.merge("c", row(3.0, 3))
    monkeypatch.undo()
    assert [r.rating for r in table.read().collect()] == [2.0]
    assert table.merge("c", row(3.0, 3)) and [r.rating for r in table.read().collect()] == [3.0]


def test_publish_once(spark, tmp_dir):
    path = f"{tmp_dir}/x/one.json"
    assert commit.publish(spark, path, {"a": 1}) and not commit.publish(spark, path, {"a": 2})
    assert commit.load(spark, path) == {"a": 1} and commit.names(spark, f"{tmp_dir}/x") == ["one.json"]
    assert commit.names(spark, f"{tmp_dir}/none") == []


# --- dictionary, distinct counts, quantiles ---------------------------------------

def test_dictionary_keeps_indexes(spark):
    loads = [[5, 3, 9, None, 3], [], [3, 1, 7], [9, 12]]
    dictionary, seen = None, {}
    for ids in loads:
        dictionary = I.extend_dictionary(dictionary, spark.createDataFrame([(i,) for i in ids], "user_id long"), "user_id")
        now = {r.user_id: r.idx for r in dictionary.collect()}
        assert all(now[k] == v for k, v in seen.items()) and sorted(now.values()) == list(range(len(now)))
        seen = now
    assert seen == {3: 0, 5: 1, 9: 2, 1: 3, 7: 4, 12: 5}


def test_distinct_counts_merge(spark):
    df = spark.range(3000).select((F.col("id") % 171 * 1000).alias("user_id"), (F.col("id") % 7 - 3).alias("movie_id"))
    df = df.unionByName(spark.createDataFrame([(None, 5), (1 << 40, None)], "user_id long, movie_id long"))
    parts = [I.distinct_state(df.where(F.coalesce("user_id", F.lit(0)) % 3000 == k * 1000), ["user_id", "movie_id"]) for k in range(3)]
    parts.append(I.distinct_state(df.where(F.col("user_id") == 1 << 40).where(F.lit(False)), ["user_id", "movie_id"]))
    got = I.summary_of(I.merge_distinct(I.merge_distinct(*parts[:2]), *parts[2:])).first()
    own = df.where((F.coalesce("user_id", F.lit(0)) % 3000).isin(0, 1000, 2000))
    want = Q.dataset_summary(own).first()
    assert tuple(got) == tuple(want)


@pytest.mark.parametrize("slack", [0.005, 0.2, -0.004])
def test_quantiles_from_merged_sketches(spark, slack):
    """Exact whatever the brackets: narrow, overlapping, or missing their ranks."""
    rng = np.random.default_rng(9)
    values = np.concatenate([rng.normal(size=20_000), np.round(rng.normal(size=3000), 1), [0.25] * 2000])
    df = spark.createDataFrame([(float(v), k % 3) for k, v in enumerate(values)] + [(None, 0)], "x double, load int")
    state = I.merge_quantiles(*[I.quantile_state(df.where(F.col("load") == k), "x") for k in range(4)])
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 0.95, "f": 1.0}
    got = I.quantiles_of(state, df, "x", probs, slack).first()
    assert [got[k] for k in probs] == pytest.approx([np.quantile(values, p) for p in probs.values()], abs=1e-12)
    none = I.merge_quantiles(I.quantile_state(df.limit(0), "x"))
    assert I.quantiles_of(none, df.limit(0), "x", {"m": 0.5}).first().m is None


# --- run log ------------------------------------------------------------------------

def test_run_log_is_idempotent_and_concurrent(spark, tmp_dir):
    log = T.RunLog(spark, f"{tmp_dir}/log")
    assert log.runs().count() == 0
    one = lambda k, v: T.RunLog(spark, f"{tmp_dir}/log").log("e", {"k_neighbors": k}, {"rmse": v}, {"status": "completed"}, f"run-{k}")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: one(k % 4, float(k)), range(12)))
    first = {r.run_id: r.metrics["rmse"] for r in log.runs().collect()}
    assert len(first) == 4 and log.runs().count() == 4
    one(2, 99.0)
    assert {r.run_id: r.metrics["rmse"] for r in log.runs().collect()} == first
    rows = spark.createDataFrame([("e", "run-2", {}, {"rmse": -1.0}, {}, 0.0), ("e", "run-9", {}, {"rmse": 9.0}, {}, 0.0)], T.RUN_SCHEMA)
    assert log.append(rows, "batch") and not log.append(rows, "batch")
    assert {r.run_id: r.metrics["rmse"] for r in log.runs().collect()} == first | {"run-9": 9.0}
    rows.write.parquet(f"{tmp_dir}/log/runs/deadbeef")               # a writer that died before its commit
    assert log.runs().count() == 5


# --- files ---------------------------------------------------------------------------

def test_quarantine(spark, tmp_dir):
    lines = ["user_id\tmovie_id\trating\ttimestamp", "1\t2\t3.5\t100", "x\t2\t3.5\t100", "1\t2\t3.5", "1\t2\t3.5\t100\t7", "", "1\t\t\t100",
             "1\t2\tn/a\t100", "1\t2\t3.5\t99999999999999999999", "5\t6\t1.0\t7"]
    os.makedirs(f"{tmp_dir}/in")
    open(f"{tmp_dir}/in/a.tsv", "w").write("\n".join(lines) + "\n")
    rows, rejects = files.read_quarantined(spark, f"{tmp_dir}/in", f"{tmp_dir}/landed")
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted([(1, 2, 3.5, 100), (1, None, None, 100), (5, 6, 1.0, 7)], key=repr)
    got = {r.line: r.reason for r in rejects.collect()}
    assert got == {"x\t2\t3.5\t100": "user_id does not parse", "1\t2\t3.5": "3 fields instead of 4", "1\t2\t3.5\t100\t7": "5 fields instead of 4",
                   "1\t2\tn/a\t100": "rating does not parse", "1\t2\t3.5\t99999999999999999999": "timestamp does not parse"}
    assert {r.file for r in rejects.collect()} == {"a.tsv"}
    assert rows.select("rating").count() + rejects.select("reason").count() == len(lines) - 2
    with pytest.raises(FileNotFoundError):
        files.read_quarantined(spark, f"{tmp_dir}/none", f"{tmp_dir}/landed")
    with pytest.raises(Exception):
        files.read_ratings_tsv(spark, f"{tmp_dir}/in").collect()


def test_ingest_scans_once(spark, tmp_dir):
    """Report and output from one run of the plan; the report is today's."""
    raw = spark.createDataFrame([(str(k % 50 + 1), k % 9 + 1, "n/a" if k % 13 == 0 else str(k % 12 / 2), 800000000 + k) for k in range(600)] + [("7", 1, None, 900000000)],
                                "user_id string, movie_id long, rating string, timestamp long")
    raw.write.parquet(f"{tmp_dir}/raw")
    source = spark.read.parquet(f"{tmp_dir}/raw")
    sc = spark.sparkContext
    sc.setJobGroup("ingest-once", "ingest")
    clean = W.ingest_strict(source, output=f"{tmp_dir}/clean", report_path=f"{tmp_dir}/report")
    sc.setJobGroup("other", "other")
    jobs = len(sc.statusTracker().getJobIdsForGroup("ingest-once"))
    assert jobs <= 5            # write with its shuffle, and the one-row report: not a second evaluation
    deduped = Q.dedup_latest(Q.coerce_types(source), ("timestamp",)).select("user_id", "movie_id", "rating", "timestamp")
    want = Q.validation_report(deduped).first().asDict()
    got = files.read_report(spark, f"{tmp_dir}/report").first().asDict()
    assert {k: v for k, v in want.items() if v is not None} == got
    assert sorted(map(tuple, clean.collect())) == sorted(map(tuple, Q.ingest_strict(source).collect()))
    assert got["rows_retained"] == clean.count()
    bad = source.where("rating = 'n/a'")
    with pytest.raises(ValueError):
        W.ingest_strict(bad, output=f"{tmp_dir}/clean")
    assert spark.read.parquet(f"{tmp_dir}/clean").count() == got["rows_retained"]       # what was there stays
    assert not glob.glob(f"{tmp_dir}/*staged*")


# --- features ---------------------------------------------------------------------------

@pytest.mark.parametrize("block", [(512, 2048), (7, 5)])
def test_matrix_blocks_rebuild_the_cells(spark, block):
    cells = spark.createDataFrame(random_cells(5, n_users=40, n_movies=30), CELLS)
    blocks, users, movies = Fe.matrix_blocks(cells, *block)
    assert sorted(map(tuple, Fe.cells_of_blocks(blocks, users, movies, *block).collect())) == sorted(map(tuple, cells.collect()))
    for b in blocks.collect():
        assert len(b.starts) == len(b.rows) + 1 and b.starts[-1] == len(b.columns) == len(b.ratings)
        assert b.rows == sorted(b.rows) and all(b.columns[x:y] == sorted(b.columns[x:y]) for x, y in zip(b.starts, b.starts[1:]))
        assert max(b.columns) < block[1] and max(b.rows) < block[0]


def test_point_lookup_reads_one_row_group(spark, tmp_dir):
    vectors = spark.range(20_000).select(F.col("id").alias("user_id"), F.transform(F.sequence(F.lit(1), F.lit(40)), lambda x: F.rand(3) + x).alias("ratings"))
    store.save_vectors(vectors, f"{tmp_dir}/v", buckets=4, block_bytes=64 << 10)
    want = vectors.where("user_id = 777").first().ratings
    assert store.lookup_vector(spark, f"{tmp_dir}/v", 777) == pytest.approx(want)
    with pytest.raises(ValueError):
        store.lookup_vector(spark, f"{tmp_dir}/v", 20_001)
    scan = store.lookup_scan(spark, f"{tmp_dir}/v", 777)
    assert len(scan.collect()) == 1
    leaf = scan._jdf.queryExecution().executedPlan().collectLeaves().head()
    metrics = {x: leaf.metrics().apply(x).value() for x in ("numOutputRows", "numFiles", "numPartitions")}
    assert metrics["numPartitions"] == 1 and metrics["numOutputRows"] < 5000 / 2      # a bucket has 5,000 rows
    with pytest.raises(TypeError):
        store.load_cells(f"{tmp_dir}/v", spark)
