import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cinerank.llm.quality import apply_rules, quality_rules, repeated_words

LIMITS = dict(min_docs=4, max_share=0.2, max_docs=1000)


def words(text):
    return (text or "").encode().split()


def brute_repeat(text, size=5):
    w = words(text)
    wins = [tuple(w[i:i + size]) for i in range(len(w) - size + 1)]
    seen = Counter(wins)
    return len({i + k for i, x in enumerate(wins) if seen[x] > 1 for k in range(size)})


def brute(rows, min_docs=5, max_share=0.1, max_docs=1000, min_left=0.5):
    norm = lambda line: b" ".join(line.encode().split()).lower()
    per_host = defaultdict(set)
    for _, t, h in rows:
        per_host[h].add(t or "")
    freq = Counter((h, n) for h, texts in per_host.items() for t in texts for n in {norm(x) for x in t.split("\n")} if n)
    out = []
    for i, t, h in rows:
        t = t or ""
        lines = [x for x in t.split("\n") if x.encode().split()]
        n = len(words(t))
        bad = {k: c > max_docs or c >= min_docs and c > max_share * len(per_host[k[0]]) for k, c in freq.items()}
        gone = [k for k, x in enumerate(t.split("\n")) if bad.get((h, norm(x)))]
        left = n - sum(len(x.split()) for k, x in enumerate(t.encode().split(b"\n")) if k in gone)
        failed = n < 10 or 100 * brute_repeat(t) > 20 * n
        out.append((i, n, sum(len(w.decode()) for w in words(t)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
                    brute_repeat(t), failed, len(lines), tuple(gone), left, not failed and left >= min_left * n))
    return sorted(out, key=repr)


def result(df):
    cols = ("doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed n_lines removed_lines n_left_words kept").split()
    return sorted((tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.select(cols).collect()), key=repr)


def corpus():
    rnd = random.Random(3)
    prose = lambda n: " ".join(f"w{rnd.randrange(900)}" for _ in range(n))
    rows = [(i, f"{prose(12)}\nSubscribe  Now\n{prose(5)}\n", f"h{i % 2}") for i in range(40)]
    rows += [(100 + i, "subscribe now\n" * 3 + "x " * i, "h0") for i in range(12)]          # depleted
    rows += [(200 + i, "one copied text of more than ten words in all, same host, kept\nwhole", "h1") for i in range(30)]
    rows += [(300, None, "h0"), (301, "", None), (302, "é ß #1 $2 <b>|x|\n\nÉ", None), (303, "a b c d e " * 30, "h1"),
             (0, rows[0][1], "h0"), (None, prose(20), "h1"), (304, "Long " + prose(30_000), "h1"), (305, "\x1c\x85 a\x0bb\x0cc\r\n\t\n" * 9, "h1")]
    return rows


def test_brute_force(docs):
    rows = corpus()
    assert result(quality_rules(docs(rows, extra=True), **LIMITS)) == brute(rows, **LIMITS)


@pytest.mark.parametrize("limits", [dict(min_docs=3, max_share=0.9, max_docs=10), dict(min_docs=50, max_share=0.1, max_docs=30), dict(min_docs=5, max_share=0.0, max_docs=4)])
def test_each_limit_acts_alone(docs, limits):
    rows = corpus()
    assert result(quality_rules(docs(rows), **limits)) == brute(rows, **limits)


def test_footer_of_a_small_host(docs):
    """A footer in all documents of a 40-document host goes; one of a few doesn't."""
    rows = [(i, f"this is document number {i} of the host with words enough {i}\nall rights reserved" + ("\nfor a few only" if i < 4 else ""), "h") for i in range(40)]
    df = docs(rows)
    got = {r.doc_id: r.text for r in apply_rules(df, quality_rules(df)).collect()}
    assert len(got) == 40 and not any("rights" in t for t in got.values()) and sum("few only" in t for t in got.values()) == 4


def test_lines_go_on_the_table(spark):
    """The limits act on sf0.01 (the SQL row means something)."""
    got = quality_rules(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert got.where("n_removed_lines > 0").count() > 10


def test_own_columns_and_long_texts(docs):
    """The caller's columns come back whatever their names; many lines of a long text go."""
    rows = [(i, f"alpha {i} beta gamma delta epsilon zeta eta theta iota kappa {i}\ncommon line\n" + "\n".join(f"v{i} {k}" for k in range(30_000 if i == 3 else 2))
             + "\ncommon line" * (20_000 if i == 3 else 1), "h") for i in range(12)]
    df = docs(rows)
    for c in ("_host", "_md5", "_kept", "_gone", "_own", "_text", "host", "kept", "_rows", "line"):
        df = df.withColumn(c, F.concat(F.lit("mine "), F.col("doc_id").cast("string")))
    got = apply_rules(df, quality_rules(df))
    assert got.columns == df.columns
    for r in got.collect():
        assert "common" not in r.text and all(r[c] == f"mine {r.doc_id}" for c in ("_host", "_md5", "_kept", "_gone", "_own", "_text", "host", "kept", "_rows", "line"))
        assert r.text == rows[r.doc_id][1].replace("\ncommon line", "")


def test_rules_take_effect(docs):
    rows = corpus()
    df = docs(rows)
    verdicts = quality_rules(df, **LIMITS)
    keep = {(r[0], r[1]): r for r in brute(rows, **LIMITS) if r[-1]}
    got = apply_rules(df, verdicts).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in brute(rows, **LIMITS) if r[-1])
    for r in got:
        assert "ubscribe" not in r.text
        if r.doc_id is not None and r.doc_id < 40:
            assert len(r.text.split()) == 17
    assert keep


def test_copies_of_one_text_count_once(docs):
    rows = [(i, "a text of ten words or more that nobody calls boilerplate", "h") for i in range(50)]
    assert all(r.kept for r in quality_rules(docs(rows), **LIMITS).collect())


@pytest.mark.parametrize("seed", range(6))
def test_repeated_words(seed):
    rnd = random.Random(seed)
    text = " ".join(rnd.choice("abc") for _ in range(rnd.randrange(0, 60)))
    assert repeated_words(words(text)) == brute_repeat(text)


def test_empty_table(docs):
    df = docs([])
    assert quality_rules(df).collect() == [] and apply_rules(df, quality_rules(df)).collect() == []
