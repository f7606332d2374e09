"""Operator 7, exact dedup: skew-safe combining (DataFrame operations only).

Local winners, then winners of salted digest groups, then winners over the
salts; every stage groups by the digest *and* the whole normalised text, so
equal digests of different texts never merge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, skew_join, stage


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 8,
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, keep_id, group_size, kept and
    digest (of the normalised text: A-Z lower-cased, null as empty).

    Texts are equal when their normalised texts are.  Of equal texts the row
    with the largest id stays; a null id is smaller than any other.  Of rows
    repeated with that id and an equal text, one has kept = true.  An empty
    table gives an empty result; other columns are not read.

    ``salts`` splits a digest group, so that a text which holds a third of all
    rows is merged by ``salts`` tasks after each map task has reduced it to one
    row a salt.  ``digest`` only has to be a function of the text: different
    texts with equal digests are told apart by their whole content.
    """
    base = (docs.select(F.col(id_col).alias("_id"),
                        ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_norm"))
            .withColumn("_digest", digest(F.col("_norm"))))

    def winners(rows: DataFrame) -> DataFrame:
        salted = (rows.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)))
                  # within a map task first (partial aggregation), then over the tasks
                  .groupBy("_digest", "_salt", "_norm")
                  .agg(F.max("_id").alias("_id"), F.count("*").alias("_n")))
        return (salted.groupBy("_digest", "_norm")
                .agg(F.max("_id").alias("_keep"), F.sum("_n").alias("_size")))

    classes = stage(winners(base).select("_digest", "_keep", "_size"))
    clashing = stage(classes.groupBy("_digest").agg(F.count("*").alias("_c"), F.sum("_size").alias("_rows"))
                     .where("_c > 1").select("_digest", "_rows"))
    # Repeated rows (same id, same text) become one row and a count here.
    rows = base.groupBy("_id", "_digest").agg(F.count("*").alias("_copies"))
    if clashing.isEmpty():
        joined = skew_join(stage(rows), classes, "_digest", "_size")
    else:
        sound = classes.join(clashing, "_digest", "left_anti")
        joined = skew_join(stage(rows.join(clashing, "_digest", "left_anti")), sound, "_digest", "_size")
        # Digests shared by different texts: these rows are joined by their content.
        apart = base.join(clashing.select("_digest"), "_digest", "left_semi")
        by_text = winners(apart).select(F.col("_digest").alias("_d"), F.col("_norm").alias("_t"),
                                        "_keep", "_size")
        own = apart.groupBy("_id", "_digest", "_norm").agg(F.count("*").alias("_copies"))
        joined = joined.unionByName(
            own.join(by_text, (F.col("_digest") == F.col("_d")) & (F.col("_norm") == F.col("_t")))
            .select("_digest", "_id", "_copies", "_keep", "_size"))
    return (joined.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy"))
            .select(F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"),
                    F.col("_size").alias("group_size"),
                    (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_copy") == 1)).alias("kept"),
                    F.col("_digest").alias("digest")))


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs).withColumnRenamed("digest", "text_sha256")


OP7_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AND row_number() OVER (PARTITION BY norm, doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
