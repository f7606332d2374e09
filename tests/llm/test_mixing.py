from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cinerank.llm import mixing
from cinerank.llm.mixing import mix_sources, repeat_texts


def brute(rows, weights=(5, 2, 1), share=Fraction(3, 2), cap=2):
    size = lambda t: len((t or "").encode().split())
    total = defaultdict(int)
    for _, t, s in rows:
        total[s] += size(t)
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, clamped, left = {}, set(), share * sum(total.values())
    while True:
        free = [s for s in order if s not in clamped]
        dealt = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if dealt[s] > cap * total[s]]
        if not over:
            break
        for s in over:
            clamped.add(s)
            target[s] = Fraction(cap * total[s])
            left -= target[s]
    return total, target | dealt


ROWS = [(i, "w " * (i % 13), f"s{i % 7}") for i in range(200)] + [(900 + i, "x y", None) for i in range(9)] \
    + [(700, "big " * 5000, "s1"), (701, None, "s2"), (702, "", "empty"), (3, "w w w", "s3"), (3, "w w w", "s3"),
       (None, "no id", "s4"), (703, "a b c", "é"), (704, "a b c", "\U0001F600")]


def test_targets_and_words(docs):
    got = mix_sources(docs(ROWS, extra=True)).collect()
    total, target = brute(ROWS)
    taken = defaultdict(int)
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, len((t or "").split())) for i, t, _ in ROWS)
    for r in got:
        assert r.source_size == total[r.source] and r.target == pytest.approx(float(target[r.source]))
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in total:
        assert abs(taken[s] - target[s]) <= Fraction(1, 2)


def test_reruns_agree_and_seeds_differ(docs):
    rows = lambda **a: sorted(map(tuple, mix_sources(docs(ROWS), **a).select("doc_id", "size", "taken").collect()), key=repr)
    assert rows() == rows() != rows(seed=1)


def test_many_sources_use_the_same_rule(docs, monkeypatch):
    want = sorted(map(str, mix_sources(docs(ROWS)).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mix_sources(docs(ROWS)).collect())) == want


def test_all_clamped(docs):
    got = mix_sources(docs([(1, "a b", "x"), (2, "c", "y")]), share=9.0).collect()
    assert sorted((r.doc_id, r.target, r.taken) for r in got) == [(1, 4.0, 4), (2, 2.0, 2)]


def test_repetitions_have_the_words_taken(docs):
    mixed = mix_sources(docs(ROWS, extra=False))
    want = {(r.doc_id, r.source): r.taken for r in mixed.collect() if r.doc_id != 3}
    got = defaultdict(int)
    for r in repeat_texts(mixed).collect():
        got[(r.doc_id, r.source)] += len(r.text.split())
    assert {k: v for k, v in got.items() if k[0] != 3} == {k: v for k, v in want.items() if v}


def test_empty_table(docs):
    assert mix_sources(docs([])).collect() == []
    assert repeat_texts(mix_sources(docs([(1, None), (2, "")]))).collect() == []


def test_own_columns_come_back(docs):
    """Columns with the operators' internal names keep the caller's values."""
    names = ("_whole", "_end", "_before", "_missing", "_key", "_hash", "_bucket", "_extra", "_copy", "_rows", "c0", "c1", "c9")
    df = docs([(i, "word " * (i + 1), f"s{i % 3}") for i in range(20)])
    for c in names:
        df = df.withColumn(c, F.concat(F.lit("mine "), F.col("doc_id").cast("string")))
    mixed = mix_sources(df)
    again = repeat_texts(mixed)
    for out in (mixed, again):
        assert out.columns[:len(df.columns)] == df.columns
        assert all(r[c] == f"mine {r.doc_id}" for r in out.collect() for c in names)
    assert sum(len(r.text.split()) for r in again.collect()) == sum(r.taken for r in mixed.collect())
