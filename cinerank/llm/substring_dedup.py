"""Operator 9, substring dedup: a count-min prefilter, then exact grouping.

Equal windows of words have equal anchors: the gram with the smallest hash in
the window.  First pass: the count-min counters of each partition's anchors (by
document) are merged, so that an anchor's estimate is never under the number of
documents with any of its windows.  Second pass: only windows with an anchor
estimated in two documents or more are digested and grouped exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, joined_words, map_arrow, skew_join, stage, text_slices

#: Words of a gram.
GRAM = 10
#: Anchors estimated in more documents than this have their windows grouped each
#: by its own digest instead of by the anchor; a group's memory is bounded by it.
HOT_ANCHOR = 10_000
#: Windows that a task combines before it sends them on.
CHUNK = 1_000_000


def anchors(joined: bytes, starts: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window of the text: the position of its anchor, and per position the
    gram's hash (the leftmost smallest hash of the window's grams)."""
    gram = min(GRAM, window)
    a, b = starts[:len(starts) - gram + 1].tolist(), ends[gram - 1:].tolist()
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(joined[x:y]) for x, y in zip(a, b)), np.uint64, len(a))
    span = window - gram + 1
    at = np.empty(len(hashes) - span + 1, np.int64)
    for k in range(0, len(at), 1 << 16):                         # bounds the comparison's memory
        part = hashes[k:k + (1 << 16) + span - 1]
        at[k:k + (1 << 16)] = np.lib.stride_tricks.sliding_window_view(part, span).argmin(axis=1) + np.arange(k, k + len(part) - span + 1)
    return at, hashes.view(np.int64)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, row, text): doc orders documents (null id first), doc and row
    together stand for a row's id and text."""
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long"))
    return docs.select(doc.alias("doc"), F.xxhash64(F.col(text_col), F.col(text_col).isNull()).alias("row"),
                       F.col(id_col).isNull().alias("no_id"), F.col(text_col).alias("text"))


def _packed(keyed: DataFrame) -> DataFrame:
    """Texts as UTF-8 packed by zstd, to be shuffled at a third of their size."""
    def pack(batch):
        press = zstandard.ZstdCompressor(level=3)
        return {c: batch[c] for c in ("doc", "row", "no_id")} | {
            "packed": [press.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch["text"].to_pylist()]}

    return map_arrow(keyed, pack, "doc long, row long, no_id boolean, packed binary")


def _unpack(data: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(data).decode("utf-8", "surrogatepass")


def repeated_anchors(keyed: DataFrame, window: int, depth: int = 2, load: int = 4) -> DataFrame:
    """(doc, row, found, hot): per document the anchors that the merged count-min
    sketch estimates in two documents or more, and which of them in many.

    A sketch row is a table of counters (cell, count), ``load`` cells an anchor:
    each task's partial sums are its partition's sketch, the shuffle merges them.
    It grows with the input and is never held as a whole by one process.
    """
    def find(batch):
        out = []
        for text in batch["text"].to_pylist():
            joined, starts, ends = joined_words(text)
            if len(starts) < window:
                out.append([])
            else:
                at, hashes = anchors(joined, starts, ends, window)
                out.append(np.unique(hashes[np.unique(at)]))
        return {"doc": batch["doc"], "row": batch["row"], "anchors": out}

    found = stage(map_arrow(keyed.select("doc", "row", "text"), find, "doc long, row long, anchors array<long>").where("size(anchors) > 0"))
    total = found.agg(F.sum(F.size("anchors"))).first()[0] or 0
    width = 1 << max(10, int(load * total).bit_length())
    each = found.select("doc", "row", F.explode("anchors").alias("anchor"))
    for r in range(depth):
        cell = F.pmod(F.xxhash64("anchor", F.lit(r)), F.lit(width))
        counters = stage(found.select(F.explode("anchors").alias("anchor")).groupBy(cell.alias("cell"))
                         .agg(F.count("*").alias("n")).where("n > 1"))
        each = stage(skew_join(each.withColumn("cell", cell), counters.withColumnRenamed("n", f"n{r}"), "cell", f"n{r}").drop("cell"))
    estimate = F.least(*[F.col(f"n{r}") for r in range(depth)]) if depth > 1 else F.col("n0")
    return (each.groupBy("doc", "row")
            .agg(F.collect_set("anchor").alias("found"),
                 F.collect_set(F.when(estimate > HOT_ANCHOR, F.col("anchor"))).alias("hot")))


def _digests(joined: bytes, starts: np.ndarray, ends: np.ndarray, window: int, at: np.ndarray) -> np.ndarray:
    """128-bit digests (two uint64 columns) of the windows that start at ``at``."""
    digest = xxhash.xxh3_128_digest
    data = b"".join([digest(joined[x:y]) for x, y in zip(starts[at].tolist(), ends[at + window - 1].tolist())])
    return np.frombuffer(data, np.uint64).reshape(-1, 2)


RUNS = "part long, doc long, row long, start long, n long, digests binary"


def window_runs(texts: DataFrame, window: int) -> DataFrame:
    """Runs of consecutive windows with repeated anchors: part (equal windows have
    equal parts), doc, row, start, n and the windows' digests.  Of equal windows in
    a task's chunk only the smallest document's go on; the others are known to be
    repeated: runs without digests."""
    target = arrow_schema(texts.sparkSession, RUNS)

    def combine(chunk: list) -> pa.RecordBatch:
        size = [len(c[2]) for c in chunk]
        doc, row = (np.repeat(np.array([c[k] for c in chunk], np.int64), size) for k in (0, 1))
        start, part, digest = (np.concatenate([c[k] for c in chunk]) for k in (2, 3, 4))
        order = np.lexsort((doc, digest[:, 1], digest[:, 0]))
        same = np.concatenate([[False], (digest[order[1:]] == digest[order[:-1]]).all(axis=1)])
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        known = np.zeros(len(order), bool)
        known[order] = doc[order] > doc[order][first]
        part = np.where(known, np.int64(0), part)
        cut = np.ones(len(doc), bool)                             # where a run begins
        cut[1:] = ((doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
                   | (part[1:] != part[:-1]) | (known[1:] != known[:-1]))
        cut[np.cumsum(size)[:-1][np.array(size[1:]) > 0]] = True  # rows may be repeated
        at = np.flatnonzero(cut)
        to = np.append(at[1:], len(cut))
        # Known runs need no group: they are dealt evenly.
        key = np.where(known[at], row[at] + start[at], part[at])
        data = [None if known[a] else digest[a:b].tobytes() for a, b in zip(at, to)]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(
            (key, doc[at], row[at], start[at], to - at, data), target)], schema=target)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = [], 0
        for batch in (s for b in batches for s in text_slices(b)):
            for doc, row, packed, found, hot in zip(*(batch[c].to_pylist() for c in ("doc", "row", "packed", "found", "hot"))):
                joined, starts, ends = joined_words(_unpack(packed))
                at, hashes = anchors(joined, starts, ends, window)
                own = hashes[at]
                for k in range(0, len(at), CHUNK):
                    windows = k + np.flatnonzero(np.isin(own[k:k + CHUNK], np.array(found, np.int64)))
                    digest = _digests(joined, starts, ends, window, windows)
                    part = own[windows]
                    if hot:
                        part = np.where(np.isin(part, np.array(hot, np.int64)), digest[:, 0].view(np.int64), part)
                    chunk.append((doc, row, windows, part, digest))
                    held += len(windows)
                    if held >= CHUNK:
                        yield combine(chunk)
                        chunk, held = [], 0
        if held:
            yield combine(chunk)

    return texts.mapInArrow(run, RUNS)


def repeated_runs(runs: DataFrame) -> DataFrame:
    """(doc, row, start, n): runs of windows that also start in a smaller document.

    The parts are sorted by document, so the first document seen with a digest
    is the smallest; a part's digests are all that is held.
    """
    schema = "doc long, row long, start long, n long"
    target = arrow_schema(runs.sparkSession, schema)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = None, {}
        for batch in batches:
            out = []
            for key, doc, row, start, n, digests in zip(*(batch[c].to_pylist() for c in batch.schema.names)):
                if digests is None:
                    out.append((doc, row, start, n))
                    continue
                if key != part:
                    part, first = key, {}
                begin = None
                for k in range(n):
                    smallest = first.setdefault(digests[16 * k:16 * k + 16], doc)
                    if smallest < doc:
                        begin = k if begin is None else begin
                    elif begin is not None:
                        out.append((doc, row, start + begin, k - begin))
                        begin = None
                if begin is not None:
                    out.append((doc, row, start + begin, n - begin))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*out) if out else [[]] * 4, target)], schema=target)

    return runs.repartition("part").sortWithinPartitions("part", "doc").mapInArrow(scan, schema)


def substring_dedup(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col`` (as long), n_words, n_removed and
    kept_text (the kept words joined by one space).

    A word is removed when a window of ``window`` words covers it whose words
    also start in a document with a smaller id, judged on the input.  A null id
    is smaller than any other; rows with equal ids are one document to each
    other, so repeats between them stay.  Null texts have no words; texts of
    fewer than ``window`` words lose nothing.  An empty table gives an empty
    result.  Other columns aren't read.
    """
    keyed = _keyed(docs, id_col, text_col)
    flagged = repeated_anchors(keyed, window)
    runs = window_runs(_packed(keyed).join(flagged, ["doc", "row"]), window)
    spans = (repeated_runs(runs).groupBy("doc", "row")
             .agg(F.collect_set(F.struct("start", "n")).alias("spans")))

    def cut(batch):
        out = {c: [] for c in ("id", "n_words", "n_removed", "kept_text")}
        for doc, no_id, packed, spans in zip(*(batch[c].to_pylist() for c in ("doc", "no_id", "packed", "spans"))):
            joined, starts, _ = joined_words(_unpack(packed))
            words = joined.split(b" ") if len(starts) else []
            gone = np.zeros(len(words) + 1, np.int64)
            for span in spans or ():
                gone[span["start"]] += 1
                gone[span["start"] + span["n"] + window - 1] -= 1
            stay = np.cumsum(gone)[:-1] == 0
            kept = words if stay.all() else [words[k] for k in np.flatnonzero(stay).tolist()]
            for column, x in zip(out.values(), (None if no_id else doc, len(words), len(words) - len(kept),
                                                b" ".join(kept).decode("utf-8", "replace"))):
                column.append(x)
        return out

    joined = _packed(keyed).join(spans, ["doc", "row"], "left")
    return (map_arrow(joined, cut, "id long, n_words long, n_removed long, kept_text string")
            .withColumnRenamed("id", id_col))


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
win AS (
  SELECT rid, doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS w
  FROM (SELECT rid, doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50)),
firsts AS (SELECT w, min(doc_id) AS first FROM win GROUP BY w HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT rid, unnest(range(i, i + 50)) AS pos FROM win JOIN firsts USING (w) WHERE first < doc_id),
words AS (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (rid, pos) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
