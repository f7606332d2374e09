import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.llm import merkle
from cinerank.llm.merkle import merkle_manifest, op11_merkle, pack_ids, rank_ids, unpack_ids


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes, arity=3):
    """Levels from the nodes to the one at the top."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def brute(rows, shown, arity=3):
    """rows and shown: (doc_id, source, lang, n_chars, text) -> result rows."""
    groups = defaultdict(list)
    for r, s in zip(rows, shown):
        groups[r[1]].append((r[0], leaf_of(r), leaf_of(s)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        trees[g] = tree([x[1] for x in groups[g]], arity)
    top = tree([trees[g][-1][0] for g in order], arity) if order else []

    def steps(levels, at):
        for level in levels[:-1]:
            a = at - at % arity
            yield at - a, level[a:at] + level[at + 1:a + arity]
            at //= arity

    out = []
    for nr, g in enumerate(order):
        for at, (i, leaf, other) in enumerate(groups[g]):
            path = [*steps(trees[g], at), *steps(top, nr)]
            folded = other
            for own, sib in path:
                folded = h(*sib[:own], folded, *sib[own:])
            root = top[-1][0]
            out.append((i, leaf, trees[g][-1][0], root, h(*[x for _, s in path for x in s]), folded, folded == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def result(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


def full(rows):
    return [(r[0], r[2] if len(r) > 2 else "src0", "en", len(r[1]) if r[1] is not None else None, r[1]) for r in rows]


CASES = [
    [(i, f"text {i}\nx", f"s{i % 4}") for i in range(100)],
    [(1, "one")],
    [(1, "a", None), (2, "b", ""), (3, "c", "Ä"), (4, "d", "z"), (-5, "e", "z")],
    [(None, "x"), (None, "y"), (None, "y"), (3, "q"), (3, "q"), (3, "p"), (-9, None), (1 << 62, ""), (-(1 << 63), "low")],
    [(7, "same\ntext")] * 40 + [(7, f"other {i}\n") for i in range(30)] + [(8, "long word\n" * 50_000)],
    [(i * 70_001 - 3_000_000, "t", "a" if i % 3 else None) for i in range(300)],
    [],
]


@pytest.mark.parametrize("rows", CASES)
def test_brute_force(docs, rows):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    shown = {"text": F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))}
    cut = [(*r[:4], r[4].replace("\n", "") if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[4]) for r in full(rows)]
    clash = docs(rows, extra=True)
    for c in ("g", "pos", "path", "top", "chunk", "levels", "id", "n", "shown", "leaf", "root"):
        clash = clash.withColumn(c, F.lit("clash"))
    assert result(merkle_manifest(clash, shown=shown)) == brute(full(rows), cut)


def test_several_rounds(docs, monkeypatch):
    """Small slot arrays and blocks of copies: the same tree through more shuffles."""
    monkeypatch.setattr(merkle, "SLOTS", 9)
    monkeypatch.setattr(merkle, "COPIES", 4)
    rows = [(i, f"t{i}", f"s{i % 13 % 5}") for i in range(400)] + [(1000, "again", "s1")] * 30
    assert result(merkle_manifest(docs(rows))) == brute(full(rows), full(rows))
    other = [(i, f"t{i}", f"s{i}") for i in range(50)]
    assert result(merkle_manifest(docs(other), arity=2)) == brute(full(other), full(other), 2)


def test_bitmaps():
    rng = np.random.default_rng(1)
    for n in (0, 1, 500, 4096, 4097, 40_000, 65_536):
        low = np.sort(rng.choice(1 << 16, n, replace=False))
        ids, directory = pack_ids(low)
        assert (unpack_ids(ids, directory) == low).all()
        ask = rng.integers(0, 1 << 16, 1000)
        assert (rank_ids(ids, directory, ask) == np.searchsorted(low, ask)).all()
        assert len(ids) <= 8192


def test_many_ids(spark):
    """Dense bitmaps and several of them: places are ranks."""
    df = spark.range(200_000, numPartitions=7).select(
        (F.col("id") * 2 - 30_000).alias("doc_id"), F.when(F.col("id") % 5 > 0, F.lit("hot")).otherwise("few").alias("source"), F.lit("x").alias("text"))
    got = merkle_manifest(df, columns=("doc_id", "text")).select("doc_id", "source", "pos", "verified").toPandas().sort_values(["source", "doc_id"])
    assert (got.groupby("source").cumcount() == got.pos).all() and got.verified.all()


def test_query(spark):
    """The whole table of sf0.01 against the brute force."""
    from tests.conftest import SF_MEDIUM
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MEDIUM}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    shown = [(*r[:4], r[4].replace("\n", "") if zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None else r[4]) for r in rows]
    got = result(op11_merkle(spark, SF_MEDIUM))
    assert got == brute(rows, shown)
    assert 0 < sum(r[-1] for r in got) < len(got)
