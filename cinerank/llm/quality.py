"""Operator 1, quality rules: cross-document line frequency.

Normalised lines are hashed in the tasks; a host's documents are counted by
their distinct texts, lines in too many of a host's documents are removed, and
documents that lose too much by it are rejected, beside base rules that look at
one document alone.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import map_arrow, skew_join, stage

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
_MIX = np.random.default_rng(5).integers(1, 1 << 63, 5, dtype=np.uint64) | np.uint64(1)


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words covered by windows of ``size`` words that occur twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    if len(index) == len(words):
        return 0
    spread = ids.astype(np.uint64)
    key = sum(spread[k:k + n] * _MIX[k] for k in range(size))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():                     # equal windows have equal keys
        return 0
    a, b = order[:-1][same], order[1:][same]
    equal = np.logical_and.reduce([ids[a + k] == ids[b + k] for k in range(size)])
    if not equal.all():                    # different windows share a key: number the windows exactly
        rank = ids[:n]
        for k in range(1, size):
            rank = np.unique(rank * (len(words) + 1) + ids[k:k + n], return_inverse=True)[1]
        hit = np.bincount(rank)[rank] > 1
    else:
        hit = np.zeros(n, bool)
        hit[a] = hit[b] = True
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + size, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def line_words(text: str) -> list[list[bytes]]:
    return [line.split() for line in text.encode("utf-8", "surrogatepass").split(b"\n")]


def line_hash(words: list[bytes]) -> int:
    """Hash of a normalised line: words joined by one space, A-Z lower-cased."""
    return xxhash.xxh3_64_intdigest(b" ".join(words).lower()) - (1 << 63)


def text_measures(text: str) -> dict:
    """The base rules' measures of one text, and hash and words of its lines."""
    lines = line_words(text)
    words = [w for line in lines for w in line]
    full = [raw for raw, line in zip(text.split("\n"), lines) if line]
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(map(text.count, BLANKS)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": len(full) - len(set(full)),
        "n_repeat_words": repeated_words(words),
        "line_no": [i for i, line in enumerate(lines) if line],
        "line_hash": [line_hash(line) for line in lines if line],
        "line_size": [len(line) for line in lines if line],
    }


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def quality_rules(docs: DataFrame, min_docs: int = 5, max_share: float = 0.1, max_docs: int = 1000, min_left: float = 0.5,
                  id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, host, text_md5, the base measures,
    base_failed, n_lines, n_removed_lines, n_left_words, removed_lines (their
    0-based numbers in the text) and kept.

    * Base: fails with under 10 words, or when words in 5-word windows that
      occur twice or more are over 20 in 100.
    * A host's documents are its distinct texts (exact copies count once, they
      are the dedup stages' business).  A line is removed when over ``max_share`` of
      them have it, ``min_docs`` at least, or when over ``max_docs`` have it, however
      large the host is.  Lines are compared as words joined by one space with A-Z
      lower-cased; lines without words are not counted.
    * kept: base_failed is false and at least ``min_left`` of the words are left.

    Null texts count as empty (no words: base_failed).  Null hosts form a host of
    their own.  Repeated rows each get their row.  Texts may be of any length (each is
    measured in time linear in it).  An empty table gives an empty result.  Other
    columns, whatever their names, aren't read.
    """
    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("null")).alias("host"),
                       F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_md5"), F.col(text_col).alias("text"))
    names = [c.split()[0] for c in MEASURES.split(", ")] + ["line_no", "line_hash", "line_size"]

    def measure(batch):
        found = [text_measures(t or "") for t in batch["text"].to_pylist()]
        return ({"id": batch["id"], "host": batch["host"], "text_md5": batch["text_md5"]}
                | {n: [f[n] for f in found] for n in names})

    id_type = docs.schema[id_col].dataType.simpleString()
    measured = stage(map_arrow(rows, measure, f"id {id_type}, host string, text_md5 string, {MEASURES}, line_no array<int>, "
                                              "line_hash array<long>, line_size array<int>")
                     .withColumn("_class", F.xxhash64("host", "text_md5")))
    # One row a host and text: copies are combined in the map tasks.
    classes = stage(measured.groupBy("host", "text_md5", "_class")
                    .agg(F.count("*").alias("_rows"), *[F.first(c).alias(c) for c in names[5:]]))
    hosts = classes.groupBy("host").agg(F.count("*").alias("_docs"))
    frequent = (classes.select("host", F.explode(F.array_distinct("line_hash")).alias("hash"))
                .groupBy("host", "hash").agg(F.count("*").alias("_n"))
                .where(F.col("_n") >= min(min_docs, max_docs + 1))
                .join(hosts, "host").where(((F.col("_n") >= min_docs) & (F.col("_n") > F.lit(max_share) * F.col("_docs"))) | (F.col("_n") > max_docs))
                .select(F.xxhash64("host", "hash").alias("_line"), "host", "hash", "_n"))
    lines = stage(classes.select("host", "text_md5", F.explode(F.arrays_zip("line_no", "line_hash", "line_size")).alias("l"))
                  .select(F.xxhash64("host", "l.line_hash").alias("_line"), F.col("host").alias("_h"),
                          F.col("l.line_hash").alias("_lh"), "text_md5", F.col("l.line_no").alias("no"), F.col("l.line_size").alias("words")))
    removed = (skew_join(lines, stage(frequent), "_line", "_n")
               .where("host = _h and hash = _lh")
               .groupBy("host", "text_md5")
               .agg(F.sum("words").alias("_gone"), F.sort_array(F.collect_list("no")).alias("removed_lines")))
    verdicts = stage(classes.select("host", "text_md5", "_class", "_rows")
                     .join(removed, ["host", "text_md5"], "left")
                     .select(F.col("host").alias("_h"), F.col("text_md5").alias("_t"), "_class", "_rows",
                             F.coalesce("_gone", F.lit(0)).alias("_gone"),
                             F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines")))
    out = skew_join(measured.drop("line_no", "line_size"), verdicts, "_class", "_rows").where("host = _h and text_md5 = _t")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    left = F.col("n_words") - F.col("_gone")
    return out.select(
        F.col("id").alias(id_col), "host", "text_md5", *names[:5], failed.alias("base_failed"),
        F.size("line_hash").cast("long").alias("n_lines"), F.size("removed_lines").cast("long").alias("n_removed_lines"),
        left.alias("n_left_words"), "removed_lines",
        (~failed & (left >= F.lit(min_left) * F.col("n_words"))).alias("kept"))


def apply_rules(docs: DataFrame, verdicts: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` (its columns, whatever their names) without the rejected documents and
    without the removed lines.  ``verdicts`` is ``quality_rules``' result; as it
    depends on host and text alone, they are its key.  A null text has no words and
    is rejected; an empty table stays empty."""
    rule = (verdicts.groupBy(F.col("host").alias("_host"), F.col("text_md5").alias("_md5"))
            .agg(F.first("kept").alias("_kept"), F.first("removed_lines").alias("_gone")))
    text = F.col(text_col)
    # The caller's columns in a struct of their own: their names can't clash with ours.
    rows = docs.select(F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("null")).alias("_host"),
                       F.md5(F.coalesce(text, F.lit(""))).alias("_md5"), text.alias("_text"),
                       F.struct(*[F.col(c) for c in docs.columns if c != text_col], F.lit(0).alias(text_col)).alias("_own"))
    met = (rows.join(rule.where("not _kept or size(_gone) > 0"), ["_host", "_md5"], "left")
           .where(F.coalesce("_kept", F.lit(True))).select("_own", "_text", "_gone"))

    def cut(batch):
        out = []
        for text, gone in zip(batch["_text"].to_pylist(), batch["_gone"].to_pylist()):
            if gone:
                gone = set(gone)
                text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
            out.append(text)
        return {"_own": batch["_own"], "_text": out}

    done = map_arrow(met, cut, StructType(met.schema.fields[:2]))
    return done.select(*[F.col("_text").alias(c) if c == text_col else F.col("_own")[c].alias(c) for c in docs.columns])


def op1_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_rules(docs).select("doc_id", *[c.split()[0] for c in MEASURES.split(", ")], "base_failed", "kept",
                                      "n_lines", "n_removed_lines", "n_left_words")


OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
l AS (
  SELECT rid, source, md5(text) AS h, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws
  FROM (SELECT rid, source, text, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
lines AS (
  SELECT rid, source, h, line, len(ws) AS w,
         translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM l),
hosts AS (SELECT source, count(DISTINCT md5(text)) AS docs FROM d GROUP BY source),
freq AS (
  SELECT lines.source, norm FROM lines JOIN hosts ON lines.source IS NOT DISTINCT FROM hosts.source
  GROUP BY lines.source, norm, docs HAVING (count(DISTINCT h) >= 5 AND count(DISTINCT h) > 0.1 * docs) OR count(DISTINCT h) > 1000),
per_line AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(freq.norm) AS n_removed, coalesce(sum(CASE WHEN freq.norm IS NOT NULL THEN w END), 0) AS gone
  FROM lines LEFT JOIN freq ON lines.source IS NOT DISTINCT FROM freq.source AND lines.norm = freq.norm
  GROUP BY rid),
win AS (
  SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM d WHERE len(words) >= 5)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS pos FROM dup) GROUP BY rid),
m AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed_lines,
         (len(words) - coalesce(gone, 0))::BIGINT AS n_left_words
  FROM d LEFT JOIN per_line USING (rid) LEFT JOIN rep USING (rid))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_left_words >= 0.5 * n_words AS kept
FROM m
"""
