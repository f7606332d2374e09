"""Tuning and sweeping K.

All K values are evaluated in one job: neighbours are ranked once up to
max(K), every vote carries its rank, and a short literal list of K values is
exploded next to it (a bounded fan-out of len(K), not a join).
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import clip
from ..functions.ranking import with_dense_index
from ..schema import DEFAULT_RATING, K_VALUES, RATING_CLIP
from ..sources import commit
from . import knn
from .quality import dedup_first


def _k_list(k_values):
    return F.explode(F.array(*[F.struct(F.lit(i).cast("bigint").alias("_pos"),
                                         F.lit(k).cast("bigint").alias("k"))
                               for i, k in enumerate(k_values)])).alias("_k")


def tune_k(val: DataFrame, nbrs: DataFrame, train: DataFrame, k_values=K_VALUES,
           unique_pairs: bool = False) -> DataFrame:
    """(k, rmse, mae, position) of the unweighted K-NN on ``val`` for
    each K — one pass, neighbours ranked once up to max(K).  ``unique_pairs``
    as in :func:`knn.predict`."""
    k_max = max(k_values)
    keys = val.select("user_id", "movie_id")
    if not unique_pairs:
        keys = keys.distinct()
    votes = knn._votes(keys, nbrs, train, k_max).select("user_id", "movie_id", "rank", "_r")
    per_k = (votes.select("*", _k_list(k_values)).select("*", "_k.*").drop("_k")
             .where(F.col("rank") <= F.col("k"))
             .groupBy("_pos", "k", "user_id", "movie_id").agg(F.avg("_r").alias("_p")))
    scored = (val.select("user_id", "movie_id", "rating", _k_list(k_values))
              .select("*", "_k.*").drop("_k")
              .join(per_k, ["_pos", "k", "user_id", "movie_id"], "left")
              .withColumn("prediction", F.coalesce(clip("_p", *RATING_CLIP), F.lit(DEFAULT_RATING))))
    e = F.col("prediction") - F.col("rating")
    return scored.groupBy("_pos", "k").agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae")).withColumnRenamed("_pos", "position")


def best_k(results: DataFrame, metric: str = "rmse") -> DataFrame:
    """The best row — min rmse / min mae / max coverage — first in
    the K list on ties.  ``results`` needs ``position``."""
    if metric in ("rmse", "mae"):
        key = F.struct(F.col(metric), F.col("position"))
    elif metric == "coverage":
        key = F.struct(-F.col(metric), F.col("position"))
    else:
        raise ValueError(f"no such metric: {metric}")
    cols = [c for c in results.columns if c != "position"]
    if "status" in results.columns:
        results = results.where(F.col("status") == "completed")
    best = results.agg(F.min_by(F.struct(*cols), key).alias("b"))
    return best.select("b.*")


def sweep_k(cells: DataFrame, ratings: DataFrame, user_split: DataFrame,
            k_values=K_VALUES) -> DataFrame:
    """User-level K-NN regression for every K: (position, k, rmse, mae,
    coverage, status); coverage = share of predictions >= 0.5.  A K that
    cannot run (< 1) is reported with status 'failed' and no metrics, and
    :func:`best_k` leaves it out."""
    valid = [k for k in k_values if isinstance(k, int) and k >= 1]
    p = knn.user_knn_predict(cells, ratings, user_split, valid)
    e = F.col("prediction") - F.col("target")
    res = p.groupBy("_pos", "k").agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg((F.col("prediction") >= 0.5).cast("double")).alias("coverage"),
    ).withColumn("status", F.lit("completed"))
    # positions refer to the caller's list (user_knn_predict numbered the valid ones)
    pos_map = F.create_map(*[x for i, k in enumerate(valid)
                             for x in (F.lit(i), F.lit(list(k_values).index(k)).cast("bigint"))])
    res = res.withColumn("position", F.element_at(pos_map, F.col("_pos"))).drop("_pos")
    failed = [(i, k) for i, k in enumerate(k_values) if k not in valid]
    if failed:
        bad = cells.sparkSession.createDataFrame(
            failed, "position bigint, k bigint").select(
            "position", "k", *[F.lit(None).cast("double").alias(c) for c in ("rmse", "mae", "coverage")],
            F.lit("failed").alias("status"))
        res = res.unionByName(bad)
    return res.select("position", "k", "rmse", "mae", "coverage", "status")


def leaderboard(runs: DataFrame) -> DataFrame:
    """Runs sorted by rmse (nulls last), with ``leaderboard_rank``;
    the first row is the best run."""
    # A run log grows with the runs, so the ranks come from range partitions.
    return with_dense_index(runs, [F.col("rmse").asc_nulls_last(), F.col("k_value").asc()], "leaderboard_rank", start=1)


def runs_from_sweep(sweep: DataFrame, experiment: str = "knn_sweep") -> DataFrame:
    """Run table rows (run_id, k_value, rmse, mae, coverage, status) from a
    sweep result; run ids are deterministic (experiment + K)."""
    return sweep.select(
        F.concat(F.lit(f"{experiment}_k"), F.col("k").cast("string")).alias("run_id"),
        F.col("k").cast("bigint").alias("k_value"), "rmse", "mae", "coverage",
        F.upper(F.col("status")).alias("status"))


# --- M15: the run log (replaces the tracking server) --------------------------

RUN_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("logged_at", T.DoubleType()),
])


class RunLog:
    """Run table with one row per (experiment, run id), shared by many writers.

    Runs are staged as a Parquet folder of their own and count once a small file
    that names the folder is published (renamed without overwriting).  A run that is
    logged again, later or by another writer at the same time, stays what the
    first commit made it; a writer that dies before its commit leaves nothing
    that is read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def append(self, runs: DataFrame, commit_id: str | None = None) -> bool:
        """Log the rows of ``runs`` (RUN_SCHEMA); False if ``commit_id`` was
        committed before (nothing is added)."""
        commit_id = commit_id or uuid.uuid4().hex
        name = f"{commit_id}.json"
        if name in commit.names(self.spark, f"{self.path}/commits"):
            return False
        folder = f"runs/{uuid.uuid4().hex}"
        runs.select(*RUN_SCHEMA.fieldNames()).write.parquet(f"{self.path}/{folder}")
        return commit.publish(self.spark, f"{self.path}/commits/{name}", {"folder": folder, "at": time.time()})

    def log(self, experiment: str, params: dict, metrics: dict, tags: dict,
            run_id: str | None = None) -> str:
        run_id = run_id or uuid.uuid4().hex
        row = (experiment, run_id, {k: str(v) for k, v in params.items()},
               {k: float(v) for k, v in metrics.items()}, {k: str(v) for k, v in tags.items()},
               time.time())
        # the commit is the run's: of two writers of one run the first one's row stays
        key = hashlib.md5(json.dumps([experiment, run_id]).encode()).hexdigest()
        self.append(self.spark.createDataFrame([row], RUN_SCHEMA), f"run-{key}")
        return run_id

    def runs(self) -> DataFrame:
        """Committed runs; of a run that several commits hold, the first commit's."""
        commits = f"{self.path}/commits"
        if not commit.names(self.spark, commits):
            return self.spark.createDataFrame([], RUN_SCHEMA)
        order = self.spark.read.schema("folder string, at double").json(commits)
        rows = (self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.path}/runs/*")
                .withColumn("folder", F.regexp_extract(F.col("_metadata.file_path"), "/(runs/[0-9a-f]+)/[^/]*$", 1)))
        return dedup_first(rows.join(order, "folder"), ("at", "folder"), ("experiment", "run_id")).select(*RUN_SCHEMA.fieldNames())

    def comparison(self, experiment: str) -> DataFrame:
        """M16 over the log: run_id, k_value, rmse, mae, coverage, training_time, status."""
        r = self.runs().where(F.col("experiment") == experiment)
        return leaderboard(r.select(
            "run_id", F.col("params")["k_neighbors"].cast("bigint").alias("k_value"),
            F.col("metrics")["rmse"].alias("rmse"), F.col("metrics")["mae"].alias("mae"),
            F.col("metrics")["coverage"].alias("coverage"),
            F.col("metrics")["training_time_seconds"].alias("training_time"),
            F.col("tags")["status"].alias("status")))


def log_rows(runs: DataFrame, experiment: str) -> DataFrame:
    """Rows for :meth:`RunLog.append` of a run table (``runs_from_sweep``)."""
    text = lambda c: F.col(c).cast("string")
    metrics = F.map_from_arrays(F.array(*map(F.lit, ("rmse", "mae", "coverage"))), F.array("rmse", "mae", "coverage"))
    return runs.select(F.lit(experiment).alias("experiment"), "run_id",
                       F.create_map(F.lit("k_neighbors"), text("k_value")).alias("params"),
                       F.map_filter(metrics, lambda _, v: v.isNotNull()).alias("metrics"),
                       F.create_map(F.lit("status"), F.col("status")).alias("tags"),
                       F.unix_timestamp().cast("double").alias("logged_at"))


def log_sweep(log: RunLog, sweep_rows: list, experiment: str, seconds: float,
              test_size: float = 0.2, random_state: int = 42) -> list[str]:
    """Log each K of a collected sweep (a handful of rows) as one run."""
    ids = []
    for r in sweep_rows:
        ids.append(log.log(
            experiment,
            {"k_neighbors": r["k"], "test_size": test_size, "random_state": random_state,
             "algorithm": "k_neighbors"},
            {"rmse": r["rmse"], "mae": r["mae"], "coverage": r["coverage"],
             "training_time_seconds": seconds},
            {"dataset": "ratings", "k_value": str(r["k"]), "status": r["status"]}))
    return ids
