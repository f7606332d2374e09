"""Continuous ingest of ratings files with Structured Streaming.

New delimited files dropped into a folder are read as a stream; each
micro-batch is type-coerced and validated by the same operators as the batch
ingest and landed as parquet under ``<landing>/_epoch=<id>`` (overwrite per
epoch, so a batch retried after a failure replaces its own output — the sink
is idempotent).  The batch's validation report goes next to it.

An unparsable int id does not stop the stream (the batch ingest's default
fails instead): the batch report carries 'Datatype conversion failed' and
the row, which has no usable key, never reaches the current table.

"Latest rating wins" spans batches, so it is not decided per batch: the
current table is the V11 dedup over everything landed (latest by timestamp,
then by later batch), keeping the row only if that latest one is valid — the
strict ingest's dedup-before-validation rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality as Q
from ..schema import RATING_COLUMNS, RATING_RULES, string_schema
from ..sources.merge import KeyedTable


def read_stream(spark: SparkSession, source_dir: str, sep: str = "\t",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Ratings text files as a stream of string columns (typed later)."""
    r = (spark.readStream.schema(string_schema()).option("header", True).option("sep", sep))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(source_dir)


#: Columns and order of a current table that micro-batches are merged into.
MERGE_ORDER = ("timestamp", "epoch", "valid")


def current_table(spark: SparkSession, path: str, buckets: int = 64) -> KeyedTable:
    """The table for ``merge_into``: the latest row of each pair over all batches,
    valid or not."""
    return KeyedTable(spark, path, order_cols=MERGE_ORDER, buckets=buckets)


def merged_ratings(table: KeyedTable) -> DataFrame:
    """The cleaned ratings of a merged table: as :func:`current_ratings`, without
    deduplicating all that ever landed."""
    return table.read().where("valid").select(*RATING_COLUMNS)


def _land(landing_dir: str, report_dir: str, rules=RATING_RULES, merge_into: KeyedTable | None = None):
    def merge(batch: DataFrame, epoch_id: int) -> None:
        typed = batch.sparkSession.read.parquet(f"{landing_dir}/_epoch={epoch_id}")
        rows = typed.where(F.col("user_id").isNotNull() & F.col("movie_id").isNotNull()).withColumn("epoch", F.lit(epoch_id).cast("long"))
        merge_into.merge(f"epoch-{epoch_id}", rows)          # a batch run again has the same id

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # Invalid rows are landed too (flagged): an older valid rating must not
        # resurface when the latest one for the pair is invalid.
        typed = Q.coerce_types(batch, rules).select(*RATING_COLUMNS)
        typed.withColumn("valid", Q.row_is_valid(rules)).write.mode("overwrite").parquet(
            f"{landing_dir}/_epoch={epoch_id}")
        Q.validation_report(batch, rules).withColumn("epoch", F.lit(epoch_id)) \
            .write.mode("overwrite").json(f"{report_dir}/_epoch={epoch_id}")
        if merge_into is not None:
            merge(batch, epoch_id)
    return per_batch


def start_ingest(stream: DataFrame, landing_dir: str, report_dir: str, checkpoint_dir: str,
                 available_now: bool = True, processing_time: str | None = None, merge_into: KeyedTable | None = None) -> StreamingQuery:
    """Start the landing query.  ``checkpoint_dir`` must be on shared storage
    on a cluster (it holds the source offsets and the commit log).  With
    ``merge_into`` each batch is merged into that table as well (:func:`current_table`)."""
    w = (stream.writeStream.foreachBatch(_land(landing_dir, report_dir, merge_into=merge_into))
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time or "1 minute")
    return w.start()


def current_ratings(spark: SparkSession, landing_dir: str) -> DataFrame:
    """The cleaned ratings as of the landed batches: latest per (user, movie)
    by (timestamp, batch), kept only if that row is valid."""
    landed = spark.read.parquet(landing_dir)
    latest = Q.dedup_latest(landed.where(F.col("user_id").isNotNull() & F.col("movie_id").isNotNull()),
                            ("timestamp", "_epoch", "valid"))
    return latest.where("valid").select(*RATING_COLUMNS)


def batch_reports(spark: SparkSession, report_dir: str) -> DataFrame:
    return spark.read.json(report_dir)
