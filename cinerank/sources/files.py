"""File sources and sinks.

Reads always pass the ratings ``StructType`` (no inference pass over the
data); writes are directory outputs so every task writes its own part file.
"""

from __future__ import annotations

import json
import uuid
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RATINGS_SCHEMA
from . import commit


def _not_found(err: Exception) -> bool:
    text = str(err)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text


def read_ratings_tsv(spark: SparkSession, path: str, schema=RATINGS_SCHEMA) -> DataFrame:
    """Tab-separated with header, typed on read; a value that does not
    parse fails the job (FAILFAST); a missing path -> FileNotFoundError."""
    return read_ratings_csv(spark, path, sep="\t", schema=schema, strict=True)


def read_ratings_csv(spark: SparkSession, path: str, sep: str = ",", schema=RATINGS_SCHEMA,
                     strict: bool = False) -> DataFrame:
    """Delimited text with header (separator is a parameter, Q17)."""
    reader = spark.read.schema(schema).option("header", True).option("sep", sep)
    if strict:
        reader = reader.option("mode", "FAILFAST")
    try:
        return reader.csv(path)
    except AnalysisException as e:
        if _not_found(e):
            raise FileNotFoundError(f"no such ratings file: {path}") from e
        raise


def read_ratings_text(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Delimited text with every column as a string (input to V4 coercion)."""
    try:
        return spark.read.option("header", True).option("sep", sep).csv(path)
    except AnalysisException as e:
        if _not_found(e):
            raise FileNotFoundError(f"no such ratings file: {path}") from e
        raise


def read_quarantined(spark: SparkSession, path: str, landing: str, sep: str = "\t", schema=RATINGS_SCHEMA,
                     header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1/V4 for files with malformed lines: (rows, rejects).

    One permissive scan lands both under ``landing``: the typed rows, and every
    line that has other than the schema's fields or a value that does not parse,
    as (file, line, reason).  Each line (but headers and blank ones) is in one of
    the two; an empty field is a null, not an error.  ``read_ratings_tsv`` (fail on
    the first such line) stays the default.
    """
    names = [f.name for f in schema.fields]
    typed = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields] + [T.StructField("_line", T.StringType(), True)])
    try:
        scan = (spark.read.schema(typed).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", "_line").csv(path))
    except AnalysisException as e:
        if _not_found(e):
            raise FileNotFoundError(f"no such ratings file: {path}") from e
        raise
    parts = F.split("_line", f"\\Q{sep}\\E", -1)
    why = F.when(F.size(parts) != len(names), F.concat(F.size(parts).cast("string"), F.lit(f" fields instead of {len(names)}")))
    for i, f in enumerate(schema.fields):
        value = F.get(parts, F.lit(i))
        why = why.when((value != "") & value.try_cast(f.dataType).isNull(), F.lit(f"{f.name} does not parse"))
    landed = scan.withColumn("_file", F.col("_metadata.file_name")).withColumn("_rejected", F.col("_line").isNotNull())
    # All columns are read and landed: a pruned CSV scan doesn't check what it skips.
    (landed.withColumn("_reason", F.when(F.col("_rejected"), F.coalesce(why, F.lit("malformed"))))
     .select(*names, "_line", "_file", "_reason", "_rejected")
     .write.mode("overwrite").partitionBy("_rejected").parquet(landing))
    stored = spark.read.schema(T.StructType(typed.fields + [T.StructField(c, T.StringType()) for c in ("_file", "_reason")]
                                            + [T.StructField("_rejected", T.BooleanType())])).parquet(landing)
    return (stored.where(~F.col("_rejected")).select(*names),
            stored.where("_rejected").select(F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_reason").alias("reason")))


def write_ratings(df: DataFrame, path: str, fmt: str = "parquet", sep: str = ",") -> int:
    """S3: write cleaned ratings (parquet by default, or CSV with header); a table
    without rows is an error: nothing was cleaned, and what lies at ``path`` stays.

    The rows are counted while they are written, to a folder beside ``path`` that
    takes its place at the end: the plan runs once.  Returns their number.
    """
    spark, seen = df.sparkSession, Observation()
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    w = df.observe(seen, F.count(F.lit(1)).alias("n")).write
    if fmt == "csv":
        w.option("header", True).option("sep", sep).csv(staged)
    else:
        w.parquet(staged)
    n = seen.get["n"]
    if not n:
        commit.file_system(spark, staged).delete(commit.hadoop_path(spark, staged), True)
        raise ValueError("nothing to save: no rating passed the checks")
    commit.move_over(spark, staged, path)
    return n


def write_report(report: DataFrame, path: str) -> bool:
    """A one-row report DataFrame as JSON (one file: the report is one
    row).  An empty report warns and writes nothing, like the reference."""
    if report.isEmpty():
        warnings.warn(f"No report to save at {path}")
        return False
    report.coalesce(1).write.mode("overwrite").json(path)
    return True


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Read a JSON report / metadata back."""
    return spark.read.json(path)


def write_json_dict(spark: SparkSession, payload: dict, path: str) -> None:
    """S5 for driver-side dictionaries (model metadata): stored as a one-row JSON table."""
    spark.createDataFrame([(json.dumps(payload, default=float),)], "doc string") \
        .coalesce(1).write.mode("overwrite").text(path)


def read_json_dict(spark: SparkSession, path: str) -> dict:
    """Metadata written by :func:`write_json_dict` (one small document)."""
    try:
        rows = spark.read.text(path).collect()
    except AnalysisException as e:
        if _not_found(e):
            raise FileNotFoundError(f"no such ratings file: {path}") from e
        raise
    return json.loads(rows[0][0])


def write_run_comparison(runs: DataFrame, path: str) -> None:
    """Run table sorted by rmse (nulls last) as CSV with header."""
    runs.orderBy(F.col("rmse").asc_nulls_last()).coalesce(1).write.mode("overwrite") \
        .option("header", True).csv(path)
