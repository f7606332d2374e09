"""Synthetic ratings like the reference's sample generator.

numpy's random stream cannot be reproduced by a distributed job, so each row
draws from hashes of (row id, seed, stream): the same ids give the same
ratings on any cluster layout and after any task retry.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import clip

# The reference's generator parameters.
# 2000 ratings, 189 users, 100 movies, seed 42; rating ~ Normal(3.5, 1.0)
# clipped to [1, 5]; timestamps uniform in [1995-01-01, 2005-01-01) UTC,
# i.e. [788918400, 1104537600) epoch seconds.
N_RATINGS, N_USERS, N_MOVIES, SEED = 2000, 189, 100, 42
RATING_MEAN, RATING_STD, RATING_MIN, RATING_MAX = 3.5, 1.0, 1.0, 5.0
TS_START, TS_END = 788918400, 1104537600

_SCALE = float(1 << 52)


def _uniform(row_id: Column, seed: int, stream: int) -> Column:
    """Uniform in (0, 1) from the first 52 bits of md5('row:seed:stream').
    md5 (not xxhash64) so that SQL engines can reproduce every draw."""
    key = F.concat_ws(":", row_id.cast("string"), F.lit(str(seed)), F.lit(str(stream)))
    bits = F.conv(F.substr(F.md5(key), F.lit(1), F.lit(13)), 16, 10).cast("bigint")
    return (bits.cast("double") + 0.5) / F.lit(_SCALE)


def ratings_from_rows(rows: DataFrame, id_col: str = "event_id", n_users: int = N_USERS,
                      n_movies: int = N_MOVIES, seed: int = SEED) -> DataFrame:
    """One synthetic rating per input row, keyed by ``id_col``."""
    rid = F.col(id_col)
    u1, u2 = _uniform(rid, seed, 3), _uniform(rid, seed, 4)
    normal = F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * u2)
    return rows.select(
        (F.floor(_uniform(rid, seed, 1) * n_users) + 1).cast("bigint").alias("user_id"),
        (F.floor(_uniform(rid, seed, 2) * n_movies) + 1).cast("bigint").alias("movie_id"),
        F.round(clip(normal * RATING_STD + RATING_MEAN, RATING_MIN, RATING_MAX), 6).alias("rating"),
        (F.floor(_uniform(rid, seed, 5) * (TS_END - TS_START)) + TS_START).cast("bigint")
        .alias("timestamp"))


def generate_ratings(spark: SparkSession, n_ratings: int = N_RATINGS, n_users: int = N_USERS,
                     n_movies: int = N_MOVIES, seed: int = SEED) -> DataFrame:
    """The reference generator's shape from ``spark.range``; sorted by
    timestamp like the original file."""
    rows = spark.range(n_ratings).withColumnRenamed("id", "event_id")
    return ratings_from_rows(rows, "event_id", n_users, n_movies, seed).orderBy("timestamp")
