"""Operator 3, toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams and itself, hashed to buckets; a text
is the mean of its words' bags.  Embeddings and softmax are trained jointly in
numpy on a bounded sample of labelled documents, so that a misspelling
never seen shares most n-gram vectors with the word it comes from.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

EDGES = ".,;:!?\"'()[]{}«»„“”¡¿-_*"
#: Longer words (texts without spaces) aren't kept in memory for when they recur.
KEPT_CHARS = 200
#: First characters of n-grams that are taken at once.
SLICE = 1 << 14


def subwords(word: str, buckets: int, shortest: int = 3, longest: int = 5) -> list[int]:
    """Buckets of a word's n-grams, with marks at its ends, and of the word."""
    marked = f"<{word}>"
    grams = [marked[i:i + n] for n in range(shortest, longest + 1) for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g.encode("utf-8", "replace")) % buckets for g in [*grams, marked + "="]]


def subword_slices(word: str, buckets: int, shortest: int = 3, longest: int = 5) -> Iterator[np.ndarray]:
    """What ``subwords`` gives, in another order and in parts of bounded size."""
    marked = f"<{word}>"
    for at in range(0, len(marked), SLICE):
        part = marked[at:at + SLICE + longest - 1]       # the n-grams that begin in the slice, whole
        yield np.array([zlib.crc32(part[i:i + n].encode("utf-8", "replace")) % buckets for n in range(shortest, longest + 1)
                        for i in range(min(SLICE, len(part) - n + 1))], np.int32)
    yield np.array([zlib.crc32((marked + "=").encode("utf-8", "replace")) % buckets], np.int32)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


class _WordBags(dict):
    """word of up to KEPT_CHARS -> buckets; starts anew when large."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: str) -> np.ndarray:
        bag = self[word] = np.array(subwords(word.strip(EDGES), self.buckets), np.int32)
        return bag

    def counts(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """Of a longer word: its buckets and how often it has them."""
        times = np.zeros(self.buckets, np.int64)
        for part in subword_slices(word.strip(EDGES), self.buckets):
            times += np.bincount(part, minlength=self.buckets)
        index = np.flatnonzero(times)
        return index.astype(np.int32), times[index]


def text_vector(text: str | None, bags: _WordBags) -> tuple[np.ndarray, np.ndarray]:
    """Sparse mean of the words' mean bags: buckets and their weights (sum 1)."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    found = [bags[w] for w in words if len(w) <= KEPT_CHARS]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    shares = [np.repeat(1.0 / (sizes * len(words)), sizes)]
    if len(found) < len(words):
        dense = np.zeros(bags.buckets)                  # all long words of a text in one vector
        for w in words:
            if len(w) > KEPT_CHARS:
                index, times = bags.counts(w)
                dense[index] += times / (times.sum() * len(words))
        found.append(np.flatnonzero(dense).astype(np.int32))
        shares.append(dense[found[-1]])
    index, at = np.unique(np.concatenate(found), return_inverse=True)
    weight = np.bincount(at, np.concatenate(shares))
    if len(bags) > 300_000:
        bags.clear()
    return index.astype(np.int32), weight.astype(np.float32)


@dataclass
class ToxicityModel:
    """What scoring needs: each bucket's share in the difference of the two
    classes' logits (embedding times softmax weights), and the bias."""

    pull: np.ndarray
    bias: float

    def scorer(self) -> _Scorer:
        return _Scorer(self)


class _Scorer(dict):
    """Word -> mean pull of its buckets, kept for recurring words of up to KEPT_CHARS."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        pull = self.model.pull
        if len(word) > KEPT_CHARS:
            total = n = 0
            for part in subword_slices(word.strip(EDGES), len(pull)):
                total, n = total + pull[part].sum(dtype=np.float64), n + len(part)
            return float(total / n)
        value = self[word] = float(pull[subwords(word.strip(EDGES), len(pull))].mean())
        return value

    def score(self, text: str | None) -> float:
        words = words_of(text)
        logit = self.model.bias + (sum(map(self.__getitem__, words)) / len(words) if words else 0.0)
        if len(self) > 600_000:
            self.clear()
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def train(indexes: list[np.ndarray], weights: list[np.ndarray], labels: np.ndarray, prior: float, buckets: int,
          dim: int = 8, steps: int = 1200, batch: int = 64, rate: float = 0.5, min_docs: int = 3, seed: int = 0) -> ToxicityModel:
    """Joint training of embeddings and softmax by AdaGrad on mini-batches.

    The same number of ``steps`` whatever the sample: a few documents are gone
    through more often.  Both classes weigh the same in the loss, and the bias is
    then moved half way to ``prior``, the toxic share of the labelled documents.
    In each step a text loses a random part of its subwords (up to 7 in 10), as
    misspellings do, so that no few of them decide.  Buckets that fewer than
    ``min_docs`` texts have tell nothing about others: they pull to no side."""
    docs = np.zeros(buckets, np.int32)
    for i in indexes:
        docs[i] += 1                                # a text has each of its buckets once
    known = docs >= min_docs
    weights = [w[known[i]] for i, w in zip(indexes, weights)]
    indexes = [i[known[i]] for i in indexes]
    rng = np.random.default_rng(seed)
    emb = (rng.random((buckets, dim), np.float32) - 0.5) / dim
    soft = (rng.random((dim, 2), np.float32) - 0.5)
    bias = np.zeros(2, np.float32)
    emb_sum, soft_sum, bias_sum = np.full(buckets, 1e-8, np.float32), np.full((dim, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    shares = np.bincount(labels, minlength=2) / max(1, len(labels))
    even = np.divide(0.5, shares, out=np.zeros(2), where=shares > 0).astype(np.float32)
    for _ in range(-(-steps // max(1, -(-len(labels) // batch))) if len(labels) else 0):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            rows = [r for r in order[at:at + batch] if len(indexes[r])]
            if not rows:
                continue
            sizes = np.array([len(indexes[r]) for r in rows])
            idx, val = np.concatenate([indexes[r] for r in rows]), np.concatenate([weights[r] for r in rows])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            val = val * (rng.random(len(val), np.float32) < np.repeat(rng.uniform(0.3, 1, len(rows)), sizes))
            mean = np.add.reduceat(emb[idx] * val[:, None], starts, axis=0)
            logit = mean @ soft + bias
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            p *= even[labels[rows], None] / len(rows)
            g_soft, g_bias, g_mean = mean.T @ p, p.sum(axis=0), p @ soft.T
            spread = np.repeat(g_mean, sizes, axis=0) * val[:, None]
            grad = np.stack([np.bincount(idx, spread[:, k], buckets) for k in range(dim)], axis=1).astype(np.float32)
            emb_sum += np.einsum("ij,ij->i", grad, grad) / dim
            emb -= grad * (rate / np.sqrt(emb_sum))[:, None]
            soft_sum += g_soft ** 2
            soft -= 0.1 * rate * g_soft / np.sqrt(soft_sum)
            bias_sum += g_bias ** 2
            bias -= 0.1 * rate * g_bias / np.sqrt(bias_sum)
    shift = np.log(prior / (1 - prior)) / 2 if 0 < prior < 1 else 0.0
    pull = np.where(known, emb @ (soft[:, 1] - soft[:, 0]), 0)
    return ToxicityModel(pull.astype(np.float32), float(bias[1] - bias[0] + shift))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_train_docs: int = 4000, buckets: int = 1 << 17, id_col: str = "doc_id",
                 text_col: str = "text", label_col: str = "toxic", **options) -> ToxicityModel:
    """Train on at most ``max_train_docs`` documents that have a label (a row of
    ``labels`` with ``id_col``), half of each class as far as there are so many,
    taken in the order of a hash of their id.  Null labels and ids are left out; of
    rows repeated with an id one counts.  Only ids are joined and sorted; the
    sample's texts are picked by a broadcast of its ids.  Their sparse vectors (at
    most ``buckets`` entries each) are made in the tasks, and one task trains.
    """
    known = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.max(F.col(label_col).cast("int")).alias("label"))
             .join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
             .withColumn("nr", F.xxhash64(F.col("id").cast("string"), F.lit("sample"))))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        return ToxicityModel(np.zeros(buckets, np.float32), -5.0 if not toxic else 5.0)
    half = max_train_docs // 2
    each = {1: min(toxic, max(half, max_train_docs - clean)), 0: min(clean, max(half, max_train_docs - toxic))}
    ids = None
    for label, n in each.items():                         # the bound of the sample
        part = known.where(F.col("label") == label).orderBy("nr").limit(n)
        ids = part if ids is None else ids.unionByName(part)
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
              .groupBy("id", "nr", "label").agg(F.min("text").alias("text")))

    def vectors(batch):
        bags = _WordBags(buckets)
        found = [text_vector(t, bags) for t in batch["text"].to_pylist()]
        return {"nr": batch["nr"], "label": batch["label"], "idx": [i for i, _ in found], "val": [v for _, v in found]}

    made = map_arrow(sample.drop("id").repartition(16), vectors, "nr long, label int, idx array<int>, val array<float>")
    prior = toxic / (toxic + clean)

    def fit(batches):
        rows = []                                  # at most max_train_docs sparse vectors
        for batch in batches:
            idx, val = batch["idx"], batch["val"]
            rows += [(nr, label, idx[k].values.to_numpy().copy(), val[k].values.to_numpy().copy())
                     for k, (nr, label) in enumerate(zip(batch["nr"].to_pylist(), batch["label"].to_pylist()))]
        rows.sort(key=lambda r: r[:2])
        model = train([r[2] for r in rows], [r[3] for r in rows], np.array([r[1] for r in rows], np.int64), prior, buckets, **options)
        yield pa.RecordBatch.from_pydict({"pull": [model.pull.tobytes()], "bias": [model.bias]})

    # The sample is bounded, so one task trains on it, not the driver; what comes back is the model.
    fitted = made.repartition(1).mapInArrow(fit, "pull binary, bias double").first()
    return ToxicityModel(np.frombuffer(fitted.pull, np.float32), fitted.bias)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and score (0 to 1) of every row's whole text; null and empty texts
    get the bias alone.  Repeated rows each get their row; other columns aren't read."""
    id_type = docs.schema[id_col].dataType.simpleString()
    scorer = []

    def score(batch):
        if not scorer:
            scorer.append(model.scorer())
        return {"id": batch["id"], "score": [scorer[0].score(t) for t in batch["text"].to_pylist()]}

    return (map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), score, f"id {id_type}, score double")
            .withColumnRenamed("id", id_col))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = fit_toxicity(docs, labels.where(~held_out))
    return score_toxicity(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                                              (F.col("score") >= 0.5).cast("int").alias("predicted"))
