"""End-to-end compositions: the reference's pipelines re-expressed as one
lazy plan each, with parquet stage tables where a later stage re-reads the
result (V15, V16, F11, M17, E11)."""

from __future__ import annotations

import time
import uuid
import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import reliable_checkpoint
from ..operators import evaluate as E
from ..operators import features as Fe
from ..operators import knn, quality as Q, split as S, tuning as T
from ..schema import K_VALUES, RATING_COLUMNS, SEED
from ..sources import files, store


# --- V15 / V16 --------------------------------------------------------------------

def ingest_strict(raw: DataFrame, order_cols=("timestamp",), output: str | None = None,
                  report_path: str | None = None, on_int_error: str = "fail") -> DataFrame:
    """Dedup latest -> validate (coerce, ranges, nulls) -> save.  The report is
    about the same deduplicated rows: with an output, it is counted while they are
    written (``observe``), so the input is scanned once; the result then reads the
    output.  With the default ``on_int_error='fail'`` an unparsable int id aborts
    the write."""
    if not output:
        clean = Q.ingest_strict(raw, order_cols, on_int_error=on_int_error)
        if report_path:
            deduped = Q.dedup_latest(Q.coerce_types(raw), order_cols).select(*RATING_COLUMNS)
            files.write_report(Q.validation_report(deduped), report_path)
        return clean
    seen = Observation()
    files.write_ratings(Q.ingest_strict(raw, order_cols, on_int_error=on_int_error,
                                        observe=lambda rows: rows.observe(seen, *Q.report_counts())), output)
    if report_path:
        counts = seen.get
        row = raw.sparkSession.createDataFrame([tuple(counts.values())], ", ".join(f"{c} bigint" for c in counts))
        files.write_report(Q.report_row(row), report_path)
    return raw.sparkSession.read.parquet(output)


def ingest_simple(raw: DataFrame, output: str | None = None) -> DataFrame:
    """Rating in [1, 5] -> keep-first dedup -> save."""
    clean = Q.ingest_simple(raw).select(*RATING_COLUMNS)
    if output:
        files.write_ratings(clean, output)
    return clean


# --- F11 -------------------------------------------------------------------------

def prepare_features(ratings: DataFrame, output_dir: str | None = None, n_lookup: int = 3):
    """checks (V2, V3, V9 warning, V10) -> cells -> similarity -> stats ->
    save -> sample lookups of the first ``n_lookup`` users.  Returns
    (cells, similarity, stats_row, lookups)."""
    Q.require_columns(ratings, RATING_COLUMNS)
    Q.require_non_empty(ratings)
    Q.assert_no_nulls(ratings, list(RATING_COLUMNS))
    soft = Q.soft_range_count(ratings).first()
    if soft["n_outside"]:
        warnings.warn(f"{soft['n_outside']} of {soft['n_rows']} ratings are outside the expected range")
    cells = Fe.rating_cells(ratings)
    sims = Fe.user_similarity(cells)
    if output_dir:
        store.save_features(cells, sims, output_dir)
        cells = store.load_cells(output_dir)
        sims = store.load_similarity(output_dir)
    stats = Fe.rating_stats(cells).first().asDict()
    first_users = cells.select("user_id").distinct().orderBy("user_id").limit(n_lookup)
    # The looked-up users' pairs alone are ranked, not all users' and then most dropped, and
    # of a store only their chunks are unpacked.
    asked = store.load_similarity(output_dir, users=[r[0] for r in first_users.collect()]) if output_dir else sims
    lookups = Fe.top_neighbors(cells, n_lookup, sims=asked.join(F.broadcast(first_users), "user_id", "left_semi"))
    return cells, sims, stats, lookups


# --- M17 -------------------------------------------------------------------------

@dataclass
class TrainResult:
    model: knn.KNNModel
    report: DataFrame
    tuning: DataFrame | None


def train(spark: SparkSession, cells: DataFrame, ratings: DataFrame, k: int = 5,
          tune: bool = False, k_values=K_VALUES, use_weights: bool = False, output: str | None = None) -> TrainResult:
    """Exact 80/20 split -> optional K tuning on the validation rows (always
    unweighted) -> final model -> validation rmse/mae.  Report row: n_train,
    n_val, k, use_similarity_weights, rmse, mae.

    The neighbours are computed once and stored.  An unweighted tuned model's
    metrics are its tuning row.  With ``output`` the model, its metadata and the
    tuning results are written below that folder (``model``, ``metadata``,
    ``tuning_results``).
    """
    s = reliable_checkpoint(S.split_rows_exact(ratings))
    train_df, val = S.side(s, "train"), S.side(s, "val").select("user_id", "movie_id", "rating")
    nbrs = reliable_checkpoint(Fe.similar_users(cells, max(k_values) if tune else k))
    tuning = best = None
    if tune:
        tuning = reliable_checkpoint(T.tune_k(val, nbrs, train_df, k_values))     # one row per K
        best = T.best_k(tuning).first()
        k = int(best["k"])
    model = knn.KNNModel(k, nbrs, train_df.select("user_id", "movie_id", "rating"), use_weights)
    counts = s.groupBy("split").count().collect()                                # two rows
    n = {r["split"]: r["count"] for r in counts}
    if best is None or use_weights:
        e = F.col("prediction") - F.col("rating")
        best = model.predict(val).agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae")).first()
    row = (n.get("train", 0), n.get("val", 0), k, use_weights, best["rmse"], best["mae"])
    report = spark.createDataFrame([row], "n_train long, n_val long, k long, use_similarity_weights boolean, rmse double, mae double")
    if output:
        store.save_model(model, f"{output}/model")
        files.write_json_dict(spark, {
            "model": model.config(), "training": {"n_train": row[0], "n_val": row[1], "tuned": tune, "k_values": list(k_values)},
            "split": {"train_share": 0.8, "seed": SEED, "exact": True}, "evaluation": {"rmse": row[4], "mae": row[5]},
        }, f"{output}/metadata")
        if tuning is not None:
            files.write_report(tuning.select("position", "k", "rmse", "mae"), f"{output}/tuning_results")
    return TrainResult(model, report, tuning)


def evaluate_stored(spark: SparkSession, model_dir: str, test_path: str, ratings_path: str, output: str | None = None) -> DataFrame:
    """E11 from what :func:`train` left: load model and metadata from
    ``model_dir``, predict the test rows (parquet) and report on them, with all
    ratings (parquet) for the sparsity part."""
    model = store.load_model(f"{model_dir}/model", spark)
    metadata = files.read_json_dict(spark, f"{model_dir}/metadata")
    scored = reliable_checkpoint(model.predict(spark.read.parquet(test_path).select("user_id", "movie_id", "rating")))
    return evaluate(scored, spark.read.parquet(ratings_path), metadata, output=output)


def sweep(spark: SparkSession, cells: DataFrame, ratings: DataFrame, output: str, k_values=K_VALUES,
          log: T.RunLog | None = None, experiment: str = "knn_sweep") -> list[dict]:
    """M13 with what it leaves behind: one run per K (run id, metrics, status,
    training time, model folder), the results JSON, and the runs in ``log``.

    Every K is evaluated by one job over one neighbour table, so a run's training
    time is that job's, shared evenly; the model folder holds the neighbours once,
    and each run its K.
    """
    began = time.perf_counter()
    rows = T.sweep_k(cells, ratings, S.split_users(cells), k_values).orderBy("position").collect()    # one row per K
    seconds = (time.perf_counter() - began) / max(1, len(rows))
    valid = [r["k"] for r in rows if r["status"] == "completed"]
    if valid:
        model = knn.fit(cells, cells, k=min(valid), k_max=max(valid))
        store.save_model(model, f"{output}/model")
    runs = []
    for r in rows:
        run = {"run_id": uuid.uuid4().hex, "k": r["k"], "rmse": r["rmse"], "mae": r["mae"], "coverage": r["coverage"],
               "status": r["status"], "training_time_seconds": seconds,
               "model": f"{output}/model" if r["status"] == "completed" else None}
        if log is not None:
            log.log(experiment, {"k_neighbors": r["k"], "test_size": 0.2, "random_state": SEED, "algorithm": "k_neighbors"},
                    {m: run[m] for m in ("rmse", "mae", "coverage", "training_time_seconds") if run[m] is not None},
                    {"dataset": "ratings", "k_value": str(r["k"]), "status": r["status"]}, run["run_id"])
        runs.append(run)
    files.write_json_dict(spark, {"experiment": experiment, "runs": runs}, f"{output}/results")
    return runs


def sample_error_metrics(ratings: DataFrame, nbrs: DataFrame, train_df: DataFrame, k: int,
                         size: int = 10, seed: int = SEED) -> DataFrame:
    """MAE / RMSE on a seeded sample of ``size`` rows (a sampling
    operator: the limit is the feature).  Sample = smallest md5 keys."""
    h = F.conv(F.substr(F.md5(F.concat_ws(":", F.col("user_id").cast("string"),
                                             F.col("movie_id").cast("string"), F.lit(str(seed)))),
                        F.lit(1), F.lit(8)), 16, 10).cast("bigint")
    sample = (ratings.select("user_id", "movie_id", "rating").withColumn("_h", h)
              .orderBy("_h", "user_id", "movie_id").limit(size).drop("_h"))
    p = knn.predict(sample, nbrs, train_df, k)
    e = F.col("prediction") - F.col("rating")
    return p.agg(F.count(F.lit(1)).cast("bigint").alias("n_samples"),
                 F.avg(F.abs(e)).alias("mae"),
                 F.sqrt(F.avg(e * e)).alias("rmse"))


# --- E11 -------------------------------------------------------------------------

def evaluate(scored: DataFrame, ratings: DataFrame, metadata: dict | None = None,
             n_movies: int | None = None, output: str | None = None) -> DataFrame:
    """The whole report as one nested row; optionally written as JSON."""
    scored = scored.select("user_id", "movie_id", "rating", "prediction")
    report = E.evaluation_report(scored, ratings, metadata, n_movies)
    if output:
        files.write_report(report, output)
    return report
