import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cinerank.llm.packing import op5_packing, pack_documents, plan_lengths, plan_patterns
from cinerank.llm.tokenizing import WordEncoder, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


ENCODER = WordEncoder(PATH, max_words=50)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(blacklist_categories=["Cs"]), st.sampled_from("aAéÉ.,' \n\t\x1ć ΣİK<|>"))))
def test_words_spell_whole_texts(text):
    plain = Tokenizer.from_file(PATH) if not hasattr(ENCODER, "plain") else ENCODER.plain
    ENCODER.plain = plain
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_special_strings(whole):
    for text in ("a <|endoftext|> B", "A<|ENDOFTEXT|>b", "X.<|startoftext|>, Y.", "Don't. it's, 3.5, (x)."):
        assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == whole(text)


def check(pieces, texts, whole, capacity):
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(docs) == set(texts)
    for doc, text in texts.items():
        ids, at = [*whole(text), 2], 0
        for p in sorted(docs[doc], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            own = ids[at:at + p.length]
            if hasattr(p, "ids"):
                assert p.ids == own
            else:
                assert p.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= capacity
    return sum(p.length for p in pieces) / (capacity * len(sequences))


def test_small_capacity(docs, whole):
    texts = {i: "word " * (i * 7 % 90) for i in range(150)} | {200: None, 201: "", 202: "long " * 30_000}
    got = pack_documents(docs(texts.items(), extra=True), capacity=64, unit=4).collect()
    assert check(got, texts, whole, 64) > 0.9


def test_query_is_dense(spark, whole):
    import pandas as pd

    sf = "/root/testdata/sf0.01"
    texts = dict(pd.read_parquet(f"{sf}/documents.parquet")[["doc_id", "text"]].values)
    assert check(op5_packing(spark, sf).collect(), texts, whole, 4096) > 0.97


def test_repeated_rows_null_ids_and_empty_table(docs):
    got = pack_documents(docs([(1, "a b"), (1, "a b"), (None, "c")])).collect()
    assert sorted((str(p.doc_id), p.length) for p in got) == [("1", 3), ("1", 3), ("None", 2)]
    assert len({(p.sequence_id, p.offset) for p in got}) == 3
    assert pack_documents(docs([])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 400), max_size=32))
def test_plans_place_every_piece(histogram):
    plan = plan_patterns(histogram, 32)
    placed = defaultdict(int)
    for pattern, uses in plan:
        assert sum(s * a for s, a in pattern.items()) <= 32
        for s, a in pattern.items():
            placed[s] += a * uses
    assert placed == histogram


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 256), st.integers(1, 400), max_size=60))
def test_bundles_place_every_piece(histogram):
    placed = defaultdict(int)
    for pattern, uses in plan_lengths(histogram, 256, 4):
        assert uses > 0 and sum(n * a for n, a in pattern.items()) <= 256
        for n, a in pattern.items():
            placed[n] += a * uses
    assert placed == histogram


def test_short_and_empty_texts_are_dense(docs, whole):
    sixteen = next(t for n in range(40) if len(whole(t := "word " * n)) == 16)      # 17 tokens with the end
    texts = {i: None if i % 8 == 0 else "" for i in range(20_000)} | {20_000 + i: sixteen for i in range(4000)}
    assert check(pack_documents(docs(texts.items())).collect(), texts, lambda t: ids(t, whole), 4096) > 0.95


def ids(text, whole, known={}):
    if text not in known:
        known[text] = whole(text)
    return known[text]


@pytest.mark.parametrize("histogram", [{1: 100_000}, {17: 50_000}, {1: 30_000, 17: 9_000}, {n: 300 for n in range(1, 60)},
                                       {n: 7 + n % 9 for n in range(1, 200)}, {33: 9_000, 65: 9_000, 129: 9_000}])
def test_plans_of_short_pieces_are_dense(histogram):
    plan = plan_lengths(histogram, 4096, 16)
    assert sum(n * k for n, k in histogram.items()) > 0.94 * 4096 * sum(uses for _, uses in plan)
