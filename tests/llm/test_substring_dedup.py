import random

import pytest

from cinerank.llm import substring_dedup as S


def brute(rows, window):
    first = {}
    order = lambda i: -(1 << 70) if i is None else i
    wins = []
    for i, t in rows:
        w = (t or "").encode().split()
        wins.append([tuple(w[k:k + window]) for k in range(len(w) - window + 1)])
        for x in wins[-1]:
            first[x] = min(first.get(x, 1 << 70), order(i))
    out = []
    for (i, t), own in zip(rows, wins):
        w = (t or "").encode().split()
        gone = {k + j for k, x in enumerate(own) if first[x] < order(i) for j in range(window)}
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


def corpus(seed=0):
    rnd = random.Random(seed)
    prose = lambda n: " ".join(f"w{rnd.randrange(60)}" for _ in range(n))
    passage, long = prose(25), prose(3000)
    rows = [(i, f"{prose(rnd.randrange(30))} {passage if i % 3 else passage[3:]} {prose(rnd.randrange(30))}") for i in range(60)]
    rows += [(100 + i, "the the the " * rnd.randrange(1, 20)) for i in range(10)] + [(200, long), (201, "x\t" + long.replace(" ", "\n")), (150, long[500:4000])]
    rows += [(300, None), (301, ""), (302, "é " * 40), (303, "É " * 40 + "é " * 40), (5, rows[7][1]), (5, rows[7][1]), (None, rows[9][1]), (None, passage)]
    rnd.shuffle(rows)
    return rows


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=repr)


@pytest.mark.parametrize("window", (5, 20))
def test_brute_force(docs, window):
    rows = corpus(window)
    assert result(S.substring_dedup(docs(rows, extra=True), window)) == brute(rows, window)


def test_small_chunks_and_hot_anchors(docs, monkeypatch):
    """Every anchor hot, and a chunk a few windows: the other ways give the same."""
    rows = corpus(4)
    monkeypatch.setattr(S, "HOT_ANCHOR", 0)
    monkeypatch.setattr(S, "CHUNK", 7)
    assert result(S.substring_dedup(docs(rows), 20)) == brute(rows, 20)


def test_sketch_never_underestimates(docs):
    rows = corpus(2)
    df = S._keyed(docs(rows), "doc_id", "text")
    flagged = {(r.doc, r.row): set(r.found) for r in S.repeated_anchors(df, 20, load=1).collect()}
    seen = {}
    for r in df.collect():
        joined, starts, ends = S.joined_words(r.text)
        if len(starts) >= 20:
            at, hashes = S.anchors(joined, starts, ends, 20)
            for h in set(hashes[at].tolist()):
                seen.setdefault(h, set()).add((r.doc, r.row))
    for h, where in seen.items():
        if len(where) > 1:
            assert all(h in flagged[k] for k in where)


def test_empty_table(docs):
    assert result(S.substring_dedup(docs([]))) == []
    assert result(S.substring_dedup(docs([(1, None)]))) == [(1, 0, 0, "")]
