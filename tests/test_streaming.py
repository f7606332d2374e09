"""Streaming ingest: two file batches land, the current table equals the
batch strict ingest over both files."""

import os
import tempfile


from cinerank.operators import quality as Q
from cinerank.schema import string_schema
from cinerank.streaming import ingest as S

HEADER = "user_id\tmovie_id\trating\ttimestamp\n"


def write(path, rows):
    with open(path, "w") as f:
        f.write(HEADER + "".join("\t".join(map(str, r)) + "\n" for r in rows))


def run_batch(spark, src, landing, reports, ckpt):
    q = S.start_ingest(S.read_stream(spark, src, max_files_per_trigger=1), landing, reports, ckpt)
    q.awaitTermination(120)


def test_stream_matches_batch_ingest(spark):
    root = tempfile.mkdtemp(prefix="cinerank-stream-")
    src, landing, reports, ckpt = (os.path.join(root, d) for d in ("in", "landing", "reports", "ckpt"))
    os.makedirs(src)
    t = 978300000
    first = [(1, 1, 4.0, t), (1, 2, 3.5, t), (2, 1, "n/a", t), (3, 1, 2.0, t)]
    second = [(1, 1, 9.0, t + 5), (1, 2, 5.0, t + 5), (3, 1, 1.0, t - 5)]
    write(os.path.join(src, "a.tsv"), first)
    run_batch(spark, src, landing, reports, ckpt)
    write(os.path.join(src, "b.tsv"), second)
    run_batch(spark, src, landing, reports, ckpt)
    got = sorted(tuple(r) for r in S.current_ratings(spark, landing).collect())
    # (1,1): latest is 9.0 (invalid) -> gone; (1,2): 5.0; (2,1) invalid; (3,1): 2.0 (later ts)
    assert got == [(1, 2, 5.0, t + 5), (3, 1, 2.0, t)]
    batch = spark.createDataFrame([tuple(map(str, r)) for r in first + second], string_schema())
    want = sorted(tuple(r) for r in Q.ingest_strict(batch).collect())
    assert got == want
    reps = S.batch_reports(spark, reports).orderBy("epoch").collect()
    assert [r.dtype_errors for r in reps] == [1, 0]


def test_stream_batch_with_bad_int(spark):
    root = tempfile.mkdtemp(prefix="cinerank-stream-")
    src, landing, reports, ckpt = (os.path.join(root, d) for d in ("in", "landing", "reports", "ckpt"))
    os.makedirs(src)
    t = 978300000
    write(os.path.join(src, "a.tsv"), [("x", 1, 4.0, t), (2, 1, 3.0, t)])
    run_batch(spark, src, landing, reports, ckpt)
    rep = S.batch_reports(spark, reports).first()
    assert rep.error == "Datatype conversion failed"
    # the unparsable id can never be keyed; the valid row of the batch is kept
    assert sorted(tuple(r) for r in S.current_ratings(spark, landing).collect()) == [(2, 1, 3.0, t)]


def test_stream_merges_into_a_current_table(spark):
    """The merged table after each batch equals the dedup over all that landed."""
    root = tempfile.mkdtemp(prefix="cinerank-stream-")
    src, landing, reports, ckpt = (os.path.join(root, d) for d in ("in", "landing", "reports", "ckpt"))
    os.makedirs(src)
    table = S.current_table(spark, os.path.join(root, "current"), buckets=4)
    t = 978300000
    for name, rows in (("a", [(1, 1, 4.0, t), (1, 2, 3.5, t), ("x", 1, 1.0, t), (3, 1, 2.0, t)]),
                       ("b", [(1, 1, 9.0, t + 5), (1, 2, 5.0, t + 5), (3, 1, 1.0, t - 5)]), ("c", [(1, 1, 4.5, t + 9)])):
        write(os.path.join(src, f"{name}.tsv"), rows)
        q = S.start_ingest(S.read_stream(spark, src, max_files_per_trigger=1), landing, reports, ckpt, merge_into=table)
        q.awaitTermination(120)
        got = sorted(tuple(r) for r in S.merged_ratings(table).collect())
        assert got == sorted(tuple(r) for r in S.current_ratings(spark, landing).collect())
    assert got == [(1, 1, 4.5, t + 9), (1, 2, 5.0, t + 5), (3, 1, 2.0, t)]
    assert table.manifest()["loads"] == ["epoch-0", "epoch-1", "epoch-2"]
