"""Every stage of the corpus pipeline against brute force on its own input."""
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import test_line_dedup as line_cases
import test_mixing as mixing_cases
import test_near_dedup as near_cases
import test_quality_rules as quality_cases
from tokenizers import Tokenizer

import corpus_pipeline as P
from cinerank.functions.ranking import stage_tables
from cinerank.llm.tokenizing import tokenizer_path


def corpus():
    rnd = random.Random(11)
    prose = lambda n: " ".join(f"w{rnd.randrange(3000)}" for _ in range(n))
    rows = [(i, f"{prose(30)}\nSubscribe  to our letter now\n{prose(12)}", "h0") for i in range(130)]        # boilerplate of a host
    rows += [(200 + i, "subscribe to our letter now\n" + prose(4), "h0") for i in range(5)]                # depleted by it
    rows += [(300 + i, f"{prose(25)}\n{prose(25)}", f"h{i % 4}") for i in range(25)]
    for i in range(8):
        text = rows[-1 - i][1].split()
        text[3] = "edited"
        rows.append((400 + i, " ".join(text), "h2"))                                                       # near copies
    rows += [(500 + i, rows[140 + i][1].split("\n")[0] + "\n" + prose(20), "h3") for i in range(6)]          # a line of another
    rows += [(600, None, "h1"), (601, "", None), (602, "too short", "h1"), (603, "a b c d e " * 30, "h1"), (604, prose(9000), None),
             rows[150], rows[150], (None, prose(40), "h1"), (605, "É " + prose(20), "é")]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def stages(spark):
    """[(name, input rows, output rows)]: each stage's output is written and read again."""
    df = spark.createDataFrame([(i, t, "en", s, len(t) if t is not None else None) for i, t, s in corpus()],
                               "doc_id long, text string, lang string, source string, n_chars long")
    out = []
    for name, step in P.STAGES:
        after = P.stage(step(spark, df, ""))
        out.append((name, df.collect(), after.collect(), after.columns))
        df = after
    return out


def three(rows):
    return [(r.doc_id, r.text, r.source) for r in rows]


def test_columns(stages):
    assert [n for n, *_ in stages] == ["quality_rules", "line_dedup", "near_dedup", "mixing", "packing"]
    assert all(c == ["doc_id", "text", "lang", "source", "n_chars"] for _, _, _, c in stages[:-1])
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for _, _, rows, _ in stages[:-1] for r in rows)


def test_quality_rules(stages):
    _, before, after, _ = stages[0]
    kept = [r for r in quality_cases.brute(three(before)) if r[-1]]
    assert 0 < len(kept) < len(before)
    assert sorted(str(r.doc_id) for r in after) == sorted(str(r[0]) for r in kept)
    assert not any("ubscribe" in r.text for r in after)
    by_id = {i: t for i, t, _ in three(before)}
    for r, gone in ((r, next(k[8] for k in kept if k[0] == r.doc_id)) for r in after):
        want = "\n".join(x for n, x in enumerate(by_id[r.doc_id].split("\n")) if n not in gone)
        assert r.text == want


def test_line_dedup(stages):
    _, before, after, _ = stages[1]
    want = line_cases.brute([(r.doc_id, r.text) for r in before], 0.9)
    assert sorted(((r.doc_id, r.text) for r in after), key=repr) == sorted(((i, t) for i, t, *_ in want), key=repr)


def test_near_dedup(stages):
    _, before, after, _ = stages[2]
    prints = {(r.doc_id, r.text): near_cases.brute_print(r.text) for r in before}
    root = near_cases.brute_components(prints.values(), 4)
    best = {}
    for (i, t), p in prints.items():
        key = (i is None, i or 0)
        best[root[p]] = min(best.get(root[p], key), key)
    assert len(after) == len(best)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in after) == sorted(best.values())


def test_mixing(stages):
    _, before, after, _ = stages[3]
    total, target = mixing_cases.brute(three(before))
    size = {r.doc_id: len((r.text or "").encode().split()) for r in before}
    taken, by_doc = defaultdict(int), Counter()
    for r in after:
        n = len(r.text.encode().split())
        taken[r.source] += n
        by_doc[r.doc_id] += n
        assert n <= size[r.doc_id]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in total)
    assert all(n <= 2 * size[d] for d, n in by_doc.items())


def test_packing(stages):
    _, before, after, _ = stages[4]
    plain = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = Counter((r.doc_id, len(plain.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in before)
    assert Counter((p.doc_id, p.doc_tokens) for p in after if p.start == 0) == want
    assert sum(p.length for p in after) == sum(n * k for (_, n), k in want.items())
    own = defaultdict(list)
    for p in after:
        own[p.sequence_id].append((p.offset, p.length))
    for parts in own.values():
        at = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == at[:-1].tolist() and at[-1] <= 4096


def test_run(spark, tmp_path, stages):
    df = spark.createDataFrame([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in stages[0][1]],
                               "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    made = set(stage_tables(spark))
    got = P.run(spark, str(tmp_path)).collect()
    assert len(set(stage_tables(spark)) - made) == 1                    # what it leaves is its result
    key = lambda rows: sorted((str(p.doc_id), p.start, p.length, p.ids_crc32) for p in rows)
    assert key(got) == key(stages[4][2])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, step in P.STAGES:
        df = P.stage(step(spark, df, ""))
    assert df.collect() == []
