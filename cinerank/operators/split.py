"""Train / validation splits (M8, M9).

Splits hash the row key with md5 instead of drawing random numbers: the same
rows land on the same side on every run, after any executor loss, and in the
DuckDB oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import split_bucket
from ..functions.ranking import dense_index
from ..schema import SEED, SPLIT_TRAIN_PCT


def split_rows(ratings: DataFrame, seed: int = SEED, train_pct: int = SPLIT_TRAIN_PCT) -> DataFrame:
    """M8: ``split`` = 'train' for about ``train_pct`` % of (user, movie) rows."""
    b = split_bucket("user_id", "movie_id", seed=seed)
    return ratings.withColumn("split", F.when(b < train_pct, "train").otherwise("val"))


def split_rows_exact(ratings: DataFrame, seed: int = SEED, frac: float = 0.8) -> DataFrame:
    """M8, exact size: the first ``int(frac * n)`` rows in (hash, user, movie)
    order are 'train' — the reference's exact count, without a single-task
    global sort (positions come from a range-partitioned index)."""
    h = F.conv(F.substr(F.md5(F.concat_ws(":", F.col("user_id").cast("string"),
                                             F.col("movie_id").cast("string"), F.lit(str(seed)))),
                        F.lit(1), F.lit(8)), 16, 10).cast("bigint")
    keyed = ratings.withColumn("_h", h)
    indexed, n = dense_index(keyed, ["_h", "user_id", "movie_id"], "_pos")
    cut = int(math.floor(n * frac))
    return (indexed.withColumn("split", F.when(F.col("_pos") < cut, "train").otherwise("val"))
            .drop("_h", "_pos"))


def split_users(users: DataFrame, seed: int = SEED, train_pct: int = SPLIT_TRAIN_PCT) -> DataFrame:
    """M9: user-level split, (user_id, split)."""
    b = split_bucket("user_id", seed=seed)
    return users.select("user_id").distinct().withColumn(
        "split", F.when(b < train_pct, "train").otherwise("val"))


def side(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name).drop("split")
