"""Operator 4, mixing sources to target weights: capped water-filling
(DataFrame operations only).

The share of all words is dealt to the sources by weight; a source above
``max_epochs`` times its size is clamped there and the excess is dealt again by
weight until none is above.  A source's target then becomes whole repetitions of
all its documents plus one seeded fractional repetition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, restored, shielded, skew_join, stage

#: Hex digits of the seeded hash that make a bucket: a source has at most 16**4
#: buckets, and only the documents of one bucket are ever sorted together.
BUCKET_DIGITS = 4
#: Up to so many sources the per-source plan (seven numbers each) is broadcast;
#: beyond, it is joined by ``skew_join``.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Words of a text (null: 0), as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _positions(sources: DataFrame) -> DataFrame:
    """``sources`` with ``_pos``: 0-based place by code point, null last.  Rows
    are sorted by range partitions; only the partitions' counts meet in one task."""
    order = F.col("_source").asc_nulls_last()
    ranged = stage(sources.repartitionByRange(order).sortWithinPartitions(order)
                   .withColumn("_part", F.spark_partition_id())
                   .withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_part").agg(F.count("*").alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return (ranged.join(F.broadcast(offsets), "_part")
            .withColumn("_pos", F.col("_before") + F.col("_row")).drop("_part", "_row", "_before"))


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """``sources`` (``_weight``, ``_source_size``) with ``_target``.

    A level rises until the clamped and the weighted targets add up to
    ``total``; each round is one aggregate over the sources.  If all sources
    are clamped, the caps are the targets (less than ``total`` is mixed).
    """
    cap = F.lit(float(max_epochs)) * F.col("_source_size")
    free = sources.agg(F.sum("_weight")).first()[0] or 0
    level = total / free if free else 0.0
    while True:
        above = cap < F.lit(level) * F.col("_weight")
        taken, free = sources.agg(F.sum(F.when(above, cap)),
                                  F.sum(F.when(~above, F.col("_weight")))).first()
        if not free:
            level = float("inf")
            break
        raised = (total - (taken or 0.0)) / free
        if raised <= level:
            break
        level = raised
    if level == float("inf"):
        return sources.withColumn("_target", cap)
    return sources.withColumn("_target", F.least(cap, F.lit(level) * F.col("_weight")))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5,
                max_epochs: float = 2.0, seed: int = 0, id_col: str = "doc_id",
                source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with size, source_size, target and taken (columns of these names
    in ``docs`` are replaced).

    * size: words of the text (null or empty: 0); source_size: their sum;
    * sources in order of code points, null last and a source of its own, weigh
      ``weights`` repeating, and share ``share`` times all words;
    * target: the source's words in the mix, at most ``max_epochs`` source_size;
    * taken: the document's words in the mix.  Every document is taken
      floor(target / source_size) times; the words then missing are taken once
      more from the documents in the order of a seeded md5 of the id (of the text
      where it is null), the last of them in part.  So a source's taken words are its rounded target, and no
      document is taken more than ceil(max_epochs) times.

    Reruns agree: ties of the hash are ordered by size and text; rows equal in
    these change places without effect.  Sources without words have target 0.
    Texts may be of any length (words are counted by Spark, row by row); all other
    columns are kept, whatever their names.  An empty table gives an empty result.
    """
    own = ["size", "source_size", "target", "taken"]
    docs, names = shielded(docs.drop(*own))
    id_col, source_col, text_col = names[id_col], names[source_col], names[text_col]
    rows = (docs.withColumn("_key", _key(F.col(source_col)))
            .withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), 
                                                         F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))))))
            .withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS)))
    sized = rows.withColumn("size", word_count(F.col(text_col)))
    # One scan: words by source and bucket, combined in the map tasks.
    buckets = stage(sized.groupBy("_key", "_bucket")
                    .agg(F.sum("size").alias("_words"), F.count("*").alias("_rows"),
                         F.first(F.col(source_col).cast("string")).alias("_source")))
    sources = _positions(buckets.groupBy("_key")
                         .agg(F.sum("_words").alias("_source_size"), F.sum("_rows").alias("_rows"),
                              F.first("_source").alias("_source")))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = stage(sources.withColumn("_weight", F.element_at(cycle, (F.col("_pos") % len(weights) + 1).cast("int"))))
    words, n_sources = sources.agg(F.sum("_source_size"), F.count("*")).first()
    plan = water_fill(sources, share * float(words or 0), max_epochs)
    epochs = F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(F.lit(0))
    plan = (plan.withColumn("_whole", epochs.cast("long"))
            .withColumn("_missing", F.floor(F.col("_target") + 0.5).cast("long") - F.col("_whole") * F.col("_source_size")))
    # The bucket in which the fractional repetition ends, and the words before it.
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (buckets.select("_key", "_bucket", "_words",
                           F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_before"))
            .join(plan.select("_key", "_missing"), "_key")
            .where("_before < _missing and _before + _words >= _missing")
            .select("_key", F.col("_bucket").alias("_end"), "_before"))
    plan = stage(plan.join(ends, "_key", "left")
                 .select("_key", "_rows", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
                         "_whole", "_missing", "_before", F.coalesce("_end", F.lit("")).alias("_end")))

    def planned(part: DataFrame) -> DataFrame:
        if n_sources <= BROADCAST_SOURCES:
            return part.join(F.broadcast(plan.drop("_rows")), "_key")
        return skew_join(part, plan, "_key", "_rows").drop("_rows")

    joined = planned(rows)
    clear = (joined.where("_bucket <> _end").withColumn("size", word_count(F.col(text_col)))
             .withColumn("_extra", F.when(F.col("_bucket") < F.col("_end"), F.col("size")).otherwise(F.lit(0).cast("long"))))
    sofar = (Window.partitionBy("_key").orderBy("_hash", "size", F.xxhash64(F.col(text_col)))
             .rowsBetween(Window.unboundedPreceding, -1))
    last = (joined.where("_bucket = _end").withColumn("size", word_count(F.col(text_col)))
            .withColumn("_left", F.col("_missing") - F.col("_before") - F.coalesce(F.sum("size").over(sofar), F.lit(0)))
            .withColumn("_extra", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("_left")))).drop("_left"))
    return (clear.unionByName(last)
            .withColumn("taken", F.col("_whole") * F.col("size") + F.col("_extra"))
            .select(*restored(names), *own))


def repeat_texts(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per repetition of a mixed document, with its text; the text of a
    repetition taken in part ends after the words taken.  Documents of which
    nothing is taken (null and empty texts) are not in the mix.  All other columns
    are kept, whatever their names."""
    mixed, names = shielded(mixed, "size", "taken")
    text = F.col(names[text_col])
    words = F.col("taken") - (F.col("_copy") - 1) * F.col("size")
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")
    return (mixed.where("taken > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")))))
            .withColumn(names[text_col], F.when(words >= F.col("size"), text).otherwise(cut))
            .select(*restored(names)))


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('0:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))) AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([5.0, 2.0, 1.0]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
c AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE AS total FROM s),
r AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS clamped,
         sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM c),
level AS (
  SELECT (total - clamped) / free AS l FROM r WHERE cap >= (total - clamped) / free * w
  ORDER BY cap / w, source NULLS LAST LIMIT 1),
p AS (
  SELECT source, source_size, least(cap, coalesce((SELECT l FROM level) * w, cap)) AS target FROM c),
q AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM p),
t AS (
  SELECT d.doc_id, d.size, q.source_size, q.target, q.whole,
         floor(q.target + 0.5)::BIGINT - q.whole * q.source_size
           - coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS missing
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, missing)))::BIGINT AS taken FROM t
"""
