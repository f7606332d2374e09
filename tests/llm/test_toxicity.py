import random

import numpy as np
import pytest

from cinerank.llm import toxicity as T
from cinerank.llm.toxicity import fit_toxicity, op3_toxicity, score_toxicity

BAD = ["grumblax", "snorvelt", "quizzard"]


def prose(rnd, n, bad=0):
    words = ["".join(rnd.choice(["th", "er", "on", "an", "re", "sh", "ing"]) for _ in range(rnd.randrange(1, 5))) for _ in range(n)]
    for _ in range(bad):
        words[rnd.randrange(n)] = rnd.choice(BAD)
    return " ".join(words)


@pytest.fixture(scope="module")
def model(spark):
    rnd = random.Random(1)
    rows = [(i, prose(rnd, 40, 3 * (i % 4 == 0)), int(i % 4 == 0)) for i in range(600)] + [(999, None, 1), (998, "", 0), (997, "x", None)]
    table = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, toxic int")
    return fit_toxicity(table, table)


def test_unseen_misspellings_and_clean_texts(docs, model):
    rnd = random.Random(2)
    toxic = [(i, prose(rnd, 40) + " grumblaxx Snorvelts! quizard,") for i in range(30)]
    clean = [(100 + i, prose(rnd, 40)) for i in range(30)]
    scores = {r.doc_id: r.score for r in score_toxicity(docs(toxic + clean), model).collect()}
    assert sum(scores[i] >= 0.5 for i, _ in toxic) >= 28
    assert sum(scores[i] >= 0.5 for i, _ in clean) <= 2


def test_odd_rows(docs, model):
    rows = [(1, None), (2, ""), (2, ""), (3, " \n"), (None, "grumblax"), (4, "grumblax " * 100_000), (5, "x" * 500_000)]
    got = score_toxicity(docs(rows, extra=True), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert score_toxicity(docs([]), model).collect() == []


def glued(rnd, n, end):
    return "\u3002".join(prose(rnd, n).split() + end)      # one word


def test_unspaced_texts_count_to_their_end(docs, model):
    rnd = random.Random(3)
    rows = []
    for i in range(10):
        start = glued(rnd, 60, [])
        rows += [(i, start + "".join(BAD * 20)), (100 + i, start + glued(rnd, 60, []))]
    long = glued(rnd, 5000, [])
    rows += [(200, long), (201, long + "".join(BAD * 2000))]
    scores = {r.doc_id: r.score for r in score_toxicity(docs(rows), model).collect()}
    assert all(scores[i] >= 0.5 for i in range(10)) and sum(scores[100 + i] >= 0.5 for i in range(10)) <= 1
    assert scores[201] >= 0.5 > scores[200]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 7, 199, 200, 201, 500, 1001])
def test_words_in_slices_are_whole(monkeypatch, size):
    monkeypatch.setattr(T, "SLICE", 100)
    rnd = random.Random(size)
    word = "".join(rnd.choice("abc\u4e2d\u6587") for _ in range(size))
    want = sorted(T.subwords(word, 1 << 17))
    assert sorted(np.concatenate(list(T.subword_slices(word, 1 << 17))).tolist()) == want
    index, weight = T.text_vector(f"a {word} b", T._WordBags(1 << 17))
    share = np.zeros(1 << 17)
    for w in ("a", word, "b"):
        own = T.subwords(w, 1 << 17)
        np.add.at(share, own, 1 / (3 * len(own)))
    assert index.tolist() == np.flatnonzero(share).tolist() and np.allclose(weight, share[index], atol=1e-6)


def test_training_reads_unspaced_texts_to_their_end(spark, docs):
    rnd = random.Random(4)
    rows = [(i, glued(rnd, 60, BAD * 5 if i % 4 == 0 else []), int(i % 4 == 0)) for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    new = [(i, glued(rnd, 60, BAD * 5 * (i < 10))) for i in range(20)]
    scores = {r.doc_id: r.score for r in score_toxicity(docs(new), fit_toxicity(table, table)).collect()}
    assert sum((scores[i] >= 0.5) == (i < 10) for i in scores) >= 18


def test_one_class_or_no_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, text string, toxic int")
    one = spark.createDataFrame([(1, "a", 0)], none.schema)
    for labelled in (none, one):
        assert score_toxicity(docs([(1, "b")]), fit_toxicity(labelled, labelled)).first().score < 0.5


def test_held_out_accuracy(spark):
    """On sf0.1: held-out rows, trained on the others."""
    sf = "/root/testdata/sf0.1"
    scored = op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").dropna(subset=["toxic"]), "doc_id").where("held_out")
    rows = scored.select("score", "toxic", "predicted").collect()
    p, y = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    rank = p.argsort().argsort()
    auc = (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.9 and (p[y == 0] >= 0.5).mean() < 0.05
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
