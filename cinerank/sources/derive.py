"""Ratings tables derived from the driver's parquet tables.

The reference ingests a ratings file the test data does not contain, so every
query derives one (see FIXTURES.md section 2):

* R1 from ``events``: user ``user_id + 1``, movie ``props.k + 1``, rating
  ``(floor(value / 10) + 1) * 0.5`` (half-star grid, values above 5 on purpose),
  latest-first order ``ts desc, event_id desc``.
* R2 from ``orders`` joined with ``lineitem``: user ``o_custkey + 1``, movie
  ``l_partkey + 1``, rating ``floor(l_quantity / 5) * 0.5``.
* RD: R1 as text with injected bad values, RDX: RD plus unparsable user ids.

Every derivation keeps the source columns that define the dedup order so the
cleaning operators can break ties totally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import epoch_seconds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def r1_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, movie_id, rating, timestamp, event_id) — one row per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        (F.col("user_id") + 1).alias("user_id"),
        (_k() + 1).alias("movie_id"),
        ((F.floor(F.col("value") / 10) + 1) * F.lit(0.5)).cast("double").alias("rating"),
        epoch_seconds("ts").alias("timestamp"),
        F.col("event_id"),
    )


R1_ORDER = ("timestamp", "event_id")          # latest wins: both descending


def r2_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, movie_id, rating, timestamp, l_orderkey, l_linenumber, l_quantity)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        (F.col("o_custkey") + 1).alias("user_id"),
        (F.col("l_partkey") + 1).alias("movie_id"),
        (F.floor(F.col("l_quantity") / 5) * F.lit(0.5)).cast("double").alias("rating"),
        epoch_seconds("l_shipdate").alias("timestamp"),
        "l_orderkey", "l_linenumber", "l_quantity",
    )


R2_ORDER = ("timestamp", "l_orderkey", "l_linenumber", "l_quantity")


def rd_raw(spark: SparkSession, sf_dir: str, bad_user_ids: bool = False) -> DataFrame:
    """R1 with text columns and injected bad values.

    rating: 'n/a' where event_id % 97 = 0, else null where event_id % 101 = 0.
    With ``bad_user_ids`` (RDX) user_id is 'x' where event_id % 1009 = 0.
    No row is removed; the validation operators have to find them.
    """
    r = r1_raw(spark, sf_dir)
    rating = (F.when(F.col("event_id") % 97 == 0, F.lit("n/a"))
              .when(F.col("event_id") % 101 == 0, F.lit(None).cast("string"))
              .otherwise(F.col("rating").cast("string")))
    user = F.col("user_id").cast("string")
    if bad_user_ids:
        user = F.when(F.col("event_id") % 1009 == 0, F.lit("x")).otherwise(user)
    return r.select(user.alias("user_id"), "movie_id", rating.alias("rating"),
                    "timestamp", "event_id")


def rt_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 with every column as text, written in several ways: ids as '7', '07'
    and '7.0', some movie ids above 2^53, times of nine and of ten digits, and
    unparsable ratings."""
    r = r1_raw(spark, sf_dir)
    user, movie, ts = (F.col(c).cast("string") for c in ("user_id", "movie_id", "timestamp"))
    way = F.col("event_id") % 3
    return r.select(
        F.when(way == 0, user).when(way == 1, F.concat(F.lit("0"), user)).otherwise(F.concat(user, F.lit(".0"))).alias("user_id"),
        F.when(F.col("event_id") % 11 == 0, (F.col("movie_id") + F.lit(9007199254740993)).cast("string"))
        .otherwise(F.concat(F.lit(" "), movie)).alias("movie_id"),
        F.when(F.col("event_id") % 97 == 0, F.lit("n/a")).otherwise(F.col("rating").cast("string")).alias("rating"),
        F.when(F.col("event_id") % 5 < 2, (F.col("timestamp") - 900000000).cast("string")).otherwise(ts).alias("timestamp"),
        "event_id")


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 as tab-separated lines (one column, value), some malformed: three fields
    where event_id % 89 = 0, five where % 83 = 0, an unparsable rating where % 97 = 0
    or user id where % 101 = 0; the rating is empty where % 103 = 0."""
    r = r1_raw(spark, sf_dir)
    e = F.col("event_id")
    user = F.when(e % 101 == 0, F.lit("x")).otherwise(F.col("user_id").cast("string"))
    rating = F.when(e % 97 == 0, F.lit("n/a")).when(e % 103 == 0, F.lit("")).otherwise(F.col("rating").cast("string"))
    whole = F.concat_ws("\t", user, F.col("movie_id").cast("string"), rating, F.col("timestamp").cast("string"))
    return r.select(F.when(e % 89 == 0, F.concat_ws("\t", user, F.col("movie_id").cast("string"), rating))
                    .when(e % 83 == 0, F.concat(whole, F.lit("\t7"))).otherwise(whole).alias("value"))


def requests_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction requests: the raw event ids (no +1 shift), so id 0 — unknown
    to every model and rejected by the request rules — occurs naturally."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("user_id").alias("user_id"),
                     _k().alias("movie_id"))
