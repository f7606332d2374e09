"""Corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing.

``STAGES`` are applied one after another to ``documents``; each takes (spark,
docs, sf_dir), and its result is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.functions.ranking import release_stages, stage_tables
from cinerank.llm.common import stage
from cinerank.llm.line_dedup import dedup_lines
from cinerank.llm.mixing import mix_sources, repeat_texts
from cinerank.llm.near_dedup import keep_one, near_dedup
from cinerank.llm.packing import pack_documents
from cinerank.llm.quality import apply_rules, quality_rules

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of ``documents``; n_chars is the present text's length."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their host's boilerplate lines."""
    return _documents(apply_rules(docs, quality_rules(docs)))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that another line like them is kept for."""
    return _documents(dedup_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return _documents(keep_one(docs, near_dedup(docs, shingle=4, max_distance=4)))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return _documents(repeat_texts(mix_sources(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    return (pack_documents(docs, payload="crc32")
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Fuzzy lines, SimHash and tokenizers aren't SQL; tests/llm/test_pipeline.py has
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result, as stored in the shared folder; the stage tables made on the
    way to it are deleted."""
    before = tuple(stage_tables(spark))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
        release_stages(spark, keep=(*before, stage_tables(spark)[-1]))
    return docs
