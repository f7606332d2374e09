import numpy as np
import pytest
from tokenizers import Tokenizer

from cinerank.llm.token_counts import RULES, join_spans, op10_token_counts, token_counts
from cinerank.llm.tokenizing import byte_encoder, tokenizer_path


def brute(ends, spans, rule):
    own, start = [], 0
    for end in ends:
        meets = [(min(end, e) - max(start, s), -i) for i, (s, e) in enumerate(spans) if s < e and s < end and start < e]
        solid = [i for i, (s, e) in enumerate(spans) if s < e]
        if meets:
            index = {"majority": -max(meets)[1], "first": -meets[0][1], "last": -meets[-1][1]}[rule]
        else:
            index = max([i for i in solid if spans[i][1] <= start], default=solid[0] if solid else 0)
        own.append(index)
        start = end
    return own


@pytest.mark.parametrize("rule", RULES)
def test_interval_join(rule):
    rng = np.random.default_rng(1)
    for _ in range(200):
        cuts = np.sort(rng.integers(0, 40, 2 * rng.integers(1, 6))).reshape(-1, 2)
        ends = np.unique(np.append(rng.integers(1, 45, rng.integers(0, 20)), 45))
        assert join_spans(ends, cuts, rule)[0].tolist() == brute(ends.tolist(), cuts.tolist(), rule)


def test_offsets_are_those_of_the_whole_text():
    slow = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    slow.encode_special_tokens = True
    for text in ("Plain words, and\n\nlines.", "é ß \U0001F600 naïve", "", "a" * 5000, "<|endoftext|> x"):
        e = slow.encode(text, add_special_tokens=False)
        ends = byte_encoder(tokenizer_path("byte_bpe_50k.tiktoken")).ends(text)
        assert len(ends) == len(e.ids) and (not len(ends) or ends[-1] == len(text.encode()))
        if text.isascii():
            assert ends.tolist() == [b for _, b in e.offsets]


def test_sections(docs):
    rows = [(1, "Hello world\n\nthird line"), (2, None), (2, None), (3, ""), (None, "no id"), (4, "x" * 300_000 + "\ny")]
    got = token_counts(docs(rows, extra=True)).collect()
    one = {(r.field, r.section): r for r in got if r.doc_id == 1}
    assert [k for k in one] == [("lang", 0), ("source", 0), ("text", 0), ("text", 1), ("text", 2)]
    assert (one["text", 0].start, one["text", 0].end) == (0, 11) and (one["text", 2].start, one["text", 2].end) == (13, 23)
    assert one["text", 1].n_tokens == 0
    for doc in (1, 3, 4, None):
        own = [r for r in got if r.doc_id == doc]
        assert sum(r.n_tokens for r in own) == own[0].doc_tokens
    assert sum(r.doc_id == 2 for r in got) == 6
    assert token_counts(docs([])).collect() == []
    with pytest.raises(ValueError):
        token_counts(docs(rows), rule="other")


def test_query_counts_every_token(spark):
    import pandas as pd

    sf = "/root/testdata/sf0.01"
    table = pd.read_parquet(f"{sf}/documents.parquet")
    slow = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = {d: len(slow.encode(f"{a}\n{s}\n{t or ''}", add_special_tokens=False).ids)
            for d, t, a, s in table[["doc_id", "text", "lang", "source"]].values[:200]}
    got = op10_token_counts(spark, sf).groupBy("doc_id").agg({"n_tokens": "sum", "doc_tokens": "max"}).toDF("d", "n", "m").collect()
    assert len(got) == len(table) and all(r.n == r.m for r in got)
    assert all(r.n == want[r.d] for r in got if r.d in want)
