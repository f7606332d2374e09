import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cinerank.llm import near_dedup as N


def brute_print(text, shingle=4):
    words = [w.decode() for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    """fingerprint -> smallest fingerprint reached."""
    prints, root = sorted(set(prints)), {}
    for p in prints:
        if p in root:
            continue
        todo = [p]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = p
                todo += [y for y in prints if y not in root and (x ^ y).bit_count() <= distance]
    return root


def brute(rows, distance):
    fp = [brute_print(t) for _, t in rows]
    root = brute_components(fp, distance)
    best = {}
    for (i, _), p in zip(rows, fp):
        if i is not None:
            best[root[p]] = min(best.get(root[p], i), i)
    return sorted(((i, f"{p:016x}", best.get(root[p])) for (i, _), p in zip(rows, fp)), key=repr)


def corpus():
    rnd = random.Random(8)
    prose = lambda n: [f"w{rnd.randrange(2000)}" for _ in range(n)]
    rows = []
    for g in range(12):
        base = prose(120)
        for _ in range(rnd.randrange(1, 12)):
            copy = list(base)
            for _ in range(rnd.randrange(3)):
                copy[rnd.randrange(len(copy))] = "edit"
            rows.append((len(rows) + 10, " ".join(copy)))
    rows += [(i + 500, rnd.choice(["a", "a b", "a b c d", "A  b", "é", "É"])) for i in range(20)]
    rows += [(600, None), (601, ""), (602, " \n"), (None, rows[3][1]), (None, "lonely null id text here"), rows[0], rows[0], (603, "x " * 200_000)]
    rnd.shuffle(rows)
    return rows


def result(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


@pytest.mark.parametrize("distance", (0, 1, 3, 4, 7))
def test_brute_force(docs, distance):
    rows = corpus()
    assert result(N.near_dedup(docs(rows, extra=True), max_distance=distance)) == brute(rows, distance)


@pytest.fixture(scope="module")
def prints():
    """Fingerprints in clusters of up to hundreds, some of them chains."""
    rnd = random.Random(3)
    out = set()
    for _ in range(40):
        seeds = [rnd.getrandbits(64)]
        for _ in range(rnd.choice([1, 3, 20, 60])):
            x = rnd.choice(seeds)
            for _ in range(rnd.randrange(1, 7)):
                x ^= 1 << rnd.randrange(64)
            seeds.append(x)
        out |= set(seeds)
    return sorted(out)


def components(spark, prints, distance):
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    found = {int(np.int64(r.fp).astype(np.uint64)): r.component for r in N.fingerprint_components(df, distance).collect()}
    groups = {}
    for p in prints:
        groups.setdefault(found.get(p, f"alone {p}"), set()).add(p)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("distance", (1, 2, 3, 4, 5))
@pytest.mark.parametrize("way", ("pairs", "members", "midpoints"))
def test_no_link_is_lost_on_any_way(spark, prints, distance, way, monkeypatch):
    if way == "midpoints" and distance > 4:
        pytest.skip("as at 3")
    monkeypatch.setattr(N, "SHORT", 1000 if way == "pairs" else 1)
    monkeypatch.setattr(N, "BLOCK", 2 if way == "midpoints" else 20_000)
    root, want = brute_components(prints, distance), {}
    for p in prints:
        want.setdefault(root[p], set()).add(p)
    assert components(spark, prints, distance) == sorted(map(sorted, want.values()))


def test_keep_one(docs):
    rows = corpus()
    df = docs(rows)
    kept = N.keep_one(df, N.near_dedup(df)).collect()
    want = brute(rows, 4)
    fp = {(i, p): c for i, p, c in want}
    groups = [fp[(r.doc_id, f"{brute_print(r.text):016x}")] for r in kept]
    named = [g for g in groups if g is not None]
    assert len(named) == len(set(named)) and set(named) == {c for _, _, c in want if c is not None}
    assert kept[0].asDict().keys() == set(df.columns)


def test_query_against_brute_force(spark):
    import pandas as pd

    sf = "/root/testdata/sf0.01"
    rows = pd.read_parquet(f"{sf}/documents.parquet")[["doc_id", "text"]].values.tolist()
    assert result(N.op6_near_dedup(spark, sf)) == brute(rows, 4)


def test_empty_table(docs):
    df = docs([])
    assert N.near_dedup(df).collect() == [] and N.keep_one(df, N.near_dedup(df)).collect() == []
    assert N.near_dedup(docs([(1, "a")])).select(F.col("kept")).first().kept


def test_kept_rows_have_their_own_columns(docs):
    df = docs([(i, f"alpha beta gamma delta epsilon zeta {i // 2}", "s") for i in range(10)] + [(3, "alpha beta gamma delta epsilon zeta 1", "s"), (None, "other words", "s")])
    names = ("_id", "_md5", "kept", "text_md5", "c0", "c1", "fp")
    for c in names:
        df = df.withColumn(c, F.concat(F.lit("mine "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    got = N.keep_one(df, N.near_dedup(df))
    assert got.columns == df.columns
    rows = got.collect()
    assert len(rows) == len({(r.doc_id, r.text) for r in rows}) and any(r.doc_id is None for r in rows)
    assert all(r[c] == f"mine {'none' if r.doc_id is None else r.doc_id}" for r in rows for c in names)
