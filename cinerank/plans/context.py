"""Standard inputs of the registered queries, built from the driver tables.

* ``clean``: R1 cleaned (latest rating per pair, rating and timestamp rules,
  ids unbounded);
* ``cells``: the feature matrix cells of ``clean`` (F1), written once per
  query as a stage table.  ``clean`` has one row per (user, movie), so the
  cells are its (user, movie, rating) rows and also serve as the ratings for
  splits, targets and reports;
* the md5 row split of the cells, 80 % train (M8);
* the K-NN model: neighbours from ``cells`` (all ratings — the reference fits
  similarity before splitting), votes from the train rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import reliable_checkpoint
from ..operators import features as Fe
from ..operators import knn, quality as Q, split as S
from ..sources import derive

K_DEFAULT = 5
N_RECOMMEND = 5


def r1_clean(spark: SparkSession, sf: str) -> DataFrame:
    return Q.clean_ratings(derive.r1_raw(spark, sf), derive.R1_ORDER)


def r2_clean(spark: SparkSession, sf: str) -> DataFrame:
    return Q.clean_ratings(derive.r2_raw(spark, sf), derive.R2_ORDER)


def r1_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Matrix cells, materialised once in the shared checkpoint folder: the
    model reads them four to five times (similarity, rated set, catalogue,
    counts) and must not redo the scan + dedup each time."""
    return reliable_checkpoint(Fe.rating_cells(r1_clean(spark, sf)))


def r2_cells(spark: SparkSession, sf: str) -> DataFrame:
    return reliable_checkpoint(Fe.rating_cells(r2_clean(spark, sf)))


def model_parts(spark: SparkSession, sf: str, k_max: int = K_DEFAULT):
    """(cells, neighbours ranked up to k_max, train, val)."""
    cells = r1_cells(spark, sf)
    # The cleaned table has one row per (user, movie), so its cells are the
    # same (user, movie, rating) rows: split the staged cells rather than
    # scanning and deduplicating the events a second time.
    s = S.split_rows(cells)
    train, val = S.side(s, "train"), S.side(s, "val")
    nbrs = Fe.similar_users(cells, k_max)
    return cells, nbrs, train, val


def scored_with_cells(spark: SparkSession, sf: str, k: int = K_DEFAULT,
                      weighted: bool = False) -> tuple[DataFrame, DataFrame]:
    """(validation rows with the K-NN prediction, the staged cells)."""
    cells, nbrs, train, val = model_parts(spark, sf, k)
    p = knn.predict(val.select("user_id", "movie_id", "rating"), nbrs, train, k, weighted,
                    unique_pairs=True)              # cells: one row per (user, movie)
    # Predicted once, materialised, then every metric is an aggregate over it.
    return reliable_checkpoint(p.select("user_id", "movie_id", "rating", "prediction")), cells


def scored_val(spark: SparkSession, sf: str, k: int = K_DEFAULT, weighted: bool = False) -> DataFrame:
    """Validation rows with the K-NN prediction: (user_id, movie_id, rating, prediction)."""
    return scored_with_cells(spark, sf, k, weighted)[0]


def user_split(cells: DataFrame) -> DataFrame:
    return S.split_users(cells)


def recommend_requests(spark: SparkSession, sf: str) -> DataFrame:
    """(user_id, n) per raw event user id: n = events/10 clamped to [1, 50];
    raw id 0 is unknown to the model."""
    ev = derive.table(spark, sf, "events")
    return ev.groupBy("user_id").agg(
        F.least(F.greatest(F.floor(F.count(F.lit(1)) / 10), F.lit(1)), F.lit(50)).cast("int").alias("n"))
