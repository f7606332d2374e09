import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cinerank.llm.exact_dedup import exact_dedup


def brute(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(low)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        rank = 0
        for i in ids:
            rank += i == keep
            out.append((i, keep, len(ids), i == keep and rank == 1, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


CASES = [
    [(1, "A b"), (2, "a B"), (3, "Äb"), (4, "äb"), (5, None), (6, ""), (7, " "), (7, " "), (7, "x")],
    [(None, "q"), (None, "Q"), (3, "q"), (None, "z"), (None, "z")],
    [(i, "same text") for i in range(500)] + [(i, f"t{i % 7}") for i in range(500, 600)],
    [(1, "word " * 200_000), (2, "WORD " * 200_000), (3, "İ"), (4, "i̇")],
    [],
]


def result(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "digest").collect()), key=repr)


@pytest.mark.parametrize("rows", CASES)
def test_brute_force(docs, rows):
    assert result(exact_dedup(docs(rows, extra=True))) == brute(rows)


@pytest.mark.parametrize("rows", CASES[:3])
def test_equal_digests_of_different_texts(docs, rows):
    """A digest that says nothing: only the whole content tells texts apart."""
    got = result(exact_dedup(docs(rows), digest=lambda c: F.lit("same"), salts=3).drop("digest")
                 .withColumn("digest", F.lit("-")))
    assert got == sorted([(*r[:4], "-") for r in brute(rows)], key=repr)
