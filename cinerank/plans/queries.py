"""Registered queries: one per operator of the inventory, each reading the
driver tables of ``sf_dir`` in full.  Oracles with the same keys and column
names are in :mod:`cinerank.plans.oracles`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import features as Fe
from ..operators import incremental as I
from ..operators import knn, quality as Q, split as S, tuning as T
from ..schema import K_VALUES, RATING_COLUMNS
from ..functions.ranking import reliable_checkpoint, stage_folder
from ..sources import derive, files, store, synthetic
from ..sources.merge import KeyedTable
from . import context as C
from . import workflows as W

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame) -> DataFrame:
    """Doubles to 6 places, for comparison; the operators return full values."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- validation and cleaning ---------------------------------------------------

def coerce_types(spark, sf):
    return Q.coerce_types(derive.rd_raw(spark, sf)).select(
        "event_id", "user_id", "movie_id", "rating", "timestamp")


def coerce_error_counts(spark, sf):
    return Q.coercion_errors(Q.coerce_types(derive.rd_raw(spark, sf)))


def range_filter(spark, sf):
    return Q.range_filter(derive.r1_raw(spark, sf))


def range_violations(spark, sf):
    return Q.range_violations(derive.r1_raw(spark, sf))


def drop_nulls(spark, sf):
    return Q.drop_nulls(Q.coerce_types(derive.rd_raw(spark, sf)))


def validation_report(spark, sf):
    return Q.validation_report(derive.rd_raw(spark, sf).drop("event_id"))


def validation_report_abort(spark, sf):
    return Q.validation_report(derive.rd_raw(spark, sf, bad_user_ids=True).drop("event_id"))


def rating_filter_1_5(spark, sf):
    return Q.rating_filter(derive.r1_raw(spark, sf))


def soft_range_count(spark, sf):
    return Q.soft_range_count(derive.r1_raw(spark, sf))


def null_columns(spark, sf):
    return Q.null_columns(Q.coerce_types(derive.rd_raw(spark, sf)),
                          ["user_id", "movie_id", "rating", "timestamp"])


def dedup_latest(spark, sf):
    return Q.dedup_latest(derive.r1_raw(spark, sf), derive.R1_ORDER)


def dedup_first(spark, sf):
    return Q.dedup_first(derive.r1_raw(spark, sf), ("event_id",))


def dataset_summary(spark, sf):
    return _round(Q.dataset_summary(C.r1_clean(spark, sf)))


def expectations(spark, sf):
    return _round(Q.expectations(derive.r1_raw(spark, sf), C.r1_clean(spark, sf)))


def ingest_strict(spark, sf):
    return W.ingest_strict(derive.rd_raw(spark, sf), order_cols=("timestamp", "event_id"))


def coerce_types_text(spark, sf):
    return Q.coerce_types(derive.rt_raw(spark, sf)).select(
        "event_id", "user_id", "movie_id", "rating", "timestamp")


def ingest_strict_text(spark, sf):
    return W.ingest_strict(derive.rt_raw(spark, sf), order_cols=("timestamp", "event_id"))


def ingest_simple(spark, sf):
    return W.ingest_simple(derive.r1_raw(spark, sf))


def valid_requests(spark, sf):
    return Q.valid_requests(derive.requests_raw(spark, sf))


# --- features ------------------------------------------------------------------

def rating_cells(spark, sf):
    # F1 on rows that are range-valid but not deduplicated: duplicates average.
    return Fe.rating_cells(Q.range_filter(derive.r1_raw(spark, sf)))


def rating_matrix(spark, sf):
    # R1's catalogue is declared: movies 1..100 (any other would fail the job)
    return Fe.rating_matrix(C.r1_cells(spark, sf), list(range(1, 101)))


def user_index(spark, sf):
    return Fe.user_index(C.r1_cells(spark, sf))


def movie_index(spark, sf):
    return Fe.movie_index(C.r1_cells(spark, sf))


def matrix_density(spark, sf):
    return _round(Fe.matrix_density(C.r1_cells(spark, sf)))


def user_similarity(spark, sf):
    return Fe.user_similarity(C.r2_cells(spark, sf))


def user_similarity_full(spark, sf):
    return Fe.user_similarity_full(C.r1_cells(spark, sf))


def similar_users(spark, sf):
    return Fe.similar_users(C.r2_cells(spark, sf), 5)


def similar_users_requested(spark, sf):
    # F7 served per request (the reference's /similar_users/{id}, k=5): R2
    # neighbours of the raw event user ids; id 0 is unknown and gets no rows
    req = derive.table(spark, sf, "events").select("user_id")
    return Fe.similar_users_for(C.r2_cells(spark, sf), req, 5)


def user_vector(spark, sf):
    return Fe.user_vectors(C.r1_cells(spark, sf))


def rating_stats(spark, sf):
    return _round(Fe.rating_stats(C.r1_cells(spark, sf)))


def user_profile(spark, sf):
    return _round(Fe.user_profile(C.r1_cells(spark, sf)))


# --- model -----------------------------------------------------------------------

def knn_predict(spark, sf):
    return C.scored_val(spark, sf, C.K_DEFAULT)


def knn_predict_weighted(spark, sf):
    return C.scored_val(spark, sf, C.K_DEFAULT, weighted=True).withColumn(
        "prediction", F.round("prediction", 6))


def predict_batch(spark, sf):
    cells, nbrs, train, _ = C.model_parts(spark, sf)
    req = derive.requests_raw(spark, sf)
    return knn.predict(req, nbrs, train, C.K_DEFAULT).select(
        "event_id", "user_id", "movie_id", "prediction")


def recommend_user(spark, sf):
    cells, nbrs, train, _ = C.model_parts(spark, sf)
    return knn.recommend(cells, nbrs, train, C.K_DEFAULT, n=50,
                         requests=C.recommend_requests(spark, sf))


def recommend_all(spark, sf):
    cells, nbrs, train, _ = C.model_parts(spark, sf)
    return knn.recommend(cells, nbrs, train, C.K_DEFAULT, n=C.N_RECOMMEND)


def recommend_rejected(spark, sf):
    # list lengths 0..60 by the number of a raw user's events; raw id 0 is unknown
    req = derive.table(spark, sf, "events").groupBy("user_id").agg((F.count("*") * 7 % 61).alias("n"))
    return knn.rejected_requests(C.r1_cells(spark, sf), req)


def predict_batch_zero_fill(spark, sf):
    cells = C.r1_cells(spark, sf)
    return knn.predict_zero_fill(derive.requests_raw(spark, sf), cells).select(
        "event_id", "user_id", "movie_id", F.round("predicted_rating", 6).alias("predicted_rating"))


def split_rows(spark, sf):
    return S.split_rows(C.r1_clean(spark, sf))


def split_rows_exact(spark, sf):
    return S.split_rows_exact(C.r1_clean(spark, sf))


def split_users(spark, sf):
    return C.user_split(C.r1_cells(spark, sf))


def user_mean_rating(spark, sf):
    return knn.user_mean_rating(C.r1_clean(spark, sf)).withColumn(
        "target", F.round("target", 6))


def user_knn_predict(spark, sf):
    # the cleaned table has one row per (user, movie): its cells carry the same
    # ratings, so one staged table serves vectors, targets and the split
    cells = C.r1_cells(spark, sf)
    p = knn.user_knn_predict(cells, cells, C.user_split(cells), (C.K_DEFAULT,))
    return p.select("user_id", F.round("prediction", 6).alias("prediction"),
                    F.round("target", 6).alias("target"))


def _tuned(spark, sf):
    cells, nbrs, train, val = C.model_parts(spark, sf, max(K_VALUES))
    return T.tune_k(val, nbrs, train, K_VALUES, unique_pairs=True)   # split of the cells


def tune_k(spark, sf):
    return _round(_tuned(spark, sf))


def tune_best_k(spark, sf):
    return _round(T.best_k(_tuned(spark, sf), "rmse"))


def _swept(spark, sf):
    cells = C.r1_cells(spark, sf)
    return T.sweep_k(cells, cells, C.user_split(cells), K_VALUES)


def sweep_k(spark, sf):
    return _round(_swept(spark, sf))


def best_run(spark, sf):
    return _round(T.best_k(_swept(spark, sf), "rmse"))


def run_leaderboard(spark, sf):
    return _round(T.leaderboard(T.runs_from_sweep(_swept(spark, sf))))


def train_report(spark, sf):
    cells = C.r1_cells(spark, sf)
    return _round(W.train(spark, cells, cells, tune=True).report)


def actual_vs_predicted(spark, sf):
    cells, nbrs, train, _ = C.model_parts(spark, sf)
    p = knn.predict(cells, nbrs, train, C.K_DEFAULT)
    return p.select("user_id", "movie_id", F.col("rating").alias("actual"),
                    F.col("prediction").alias("predicted"),
                    F.abs(F.col("rating") - F.col("prediction")).alias("abs_error"))


def sample_error_metrics(spark, sf):
    cells, nbrs, train, _ = C.model_parts(spark, sf)
    return _round(W.sample_error_metrics(cells, nbrs, train, C.K_DEFAULT, size=10))


# --- evaluation --------------------------------------------------------------------

def rating_metrics(spark, sf):
    return _round(E.rating_metrics(C.scored_val(spark, sf)))


def error_percentiles(spark, sf):
    return _round(E.error_percentiles(C.scored_val(spark, sf)))


def catalog_coverage(spark, sf):
    return _round(E.catalog_coverage(C.scored_val(spark, sf)))


def catalog_coverage_35(spark, sf):
    return _round(E.catalog_coverage(C.scored_val(spark, sf), 3.5))


def coverage_verdict(spark, sf):
    return _round(E.coverage_verdict(E.catalog_coverage(C.scored_val(spark, sf), 3.5)))


def sparsity(spark, sf):
    return _round(E.sparsity(C.r1_clean(spark, sf)))


def ratings_per_user_stats(spark, sf):
    return _round(E.ratings_per_stats(C.r1_clean(spark, sf), "user_id"))


def ratings_per_movie_stats(spark, sf):
    return _round(E.ratings_per_stats(C.r1_clean(spark, sf), "movie_id"))


def error_histogram(spark, sf):
    return _round(E.error_histogram(C.scored_val(spark, sf)))


def baselines(spark, sf):
    return _round(E.baselines(C.scored_val(spark, sf)))


def engagement_segments(spark, sf):
    return _round(E.engagement_segments(C.scored_val(spark, sf)))


def beats_baseline(spark, sf):
    s = C.scored_val(spark, sf)
    return _round(E.beats_baseline(E.rating_metrics(s), E.baselines(s)))


def evaluation_report(spark, sf):
    scored, cells = C.scored_with_cells(spark, sf)
    return W.evaluate(scored, cells)


def evaluation_metrics(spark, sf):
    scored, cells = C.scored_with_cells(spark, sf)
    return _round(E.report_metrics(W.evaluate(scored, cells)))


def similarity_off_grid(spark, sf):
    # F1 averages duplicates, so these cells lie off the half-star grid
    return Fe.user_similarity(rating_cells(spark, sf))


# --- sources and sinks, written to the shared stage folder and read back -----------

def ratings_tsv_round_trip(spark, sf):
    path = f"{stage_folder(spark)}/ratings"
    files.write_ratings(C.r1_clean(spark, sf), path, fmt="csv", sep="\t")
    return files.read_ratings_tsv(spark, path)


def ratings_csv_round_trip(spark, sf):
    path = f"{stage_folder(spark)}/ratings"
    files.write_ratings(C.r1_clean(spark, sf), path, fmt="csv")
    return files.read_ratings_csv(spark, path)


def feature_store_round_trip(spark, sf):
    path = f"{stage_folder(spark)}/features"
    cells = C.r1_cells(spark, sf)
    store.save_features(cells, Fe.user_similarity(cells), path)
    return store.load_similarity(path, spark)


def model_store_round_trip(spark, sf):
    path = f"{stage_folder(spark)}/model"
    cells, nbrs, train, val = C.model_parts(spark, sf)
    store.save_model(knn.KNNModel(C.K_DEFAULT, nbrs, train), path)
    return store.load_model(path, spark).predict(val.select("user_id", "movie_id", "rating"))


def report_round_trip(spark, sf):
    path = f"{stage_folder(spark)}/report"
    files.write_report(validation_report(spark, sf), path)
    return files.read_report(spark, path).select("total_errors", "dtype_errors", "range_violations", "null_violations", "rows_retained")


def prepare_features_lookups(spark, sf):
    return W.prepare_features(C.r1_clean(spark, sf), f"{stage_folder(spark)}/features")[3]


# --- one pass, once, and per load ------------------------------------------------------

def ingest_strict_written(spark, sf):
    # output and report from one run of the plan (observe); the rows as stored
    folder = stage_folder(spark)
    return W.ingest_strict(derive.rd_raw(spark, sf), ("timestamp", "event_id"), f"{folder}/clean", f"{folder}/report")


def ingest_strict_report(spark, sf):
    folder = stage_folder(spark)
    W.ingest_strict(derive.rd_raw(spark, sf), ("timestamp", "event_id"), f"{folder}/clean", f"{folder}/report")
    return files.read_report(spark, f"{folder}/report").select("total_errors", "dtype_errors", "range_violations", "null_violations", "rows_retained")


def _quarantined(spark, sf):
    folder = stage_folder(spark)
    derive.rating_lines(spark, sf).write.text(f"{folder}/lines")
    return files.read_quarantined(spark, f"{folder}/lines", f"{folder}/landed", header=False)


def quarantine_rows(spark, sf):
    return _quarantined(spark, sf)[0]


def quarantine_rejects(spark, sf):
    return _quarantined(spark, sf)[1].select("line", "reason")


def _loads(rows: DataFrame, of: str) -> list[DataFrame]:
    return [rows.where(F.col(of) % 3 == k) for k in range(3)]


def dedup_latest_merged(spark, sf):
    # V11 over three loads, one of them replayed
    table = KeyedTable(spark, f"{stage_folder(spark)}/ratings", order_cols=derive.R1_ORDER, buckets=16)
    loads = _loads(derive.r1_raw(spark, sf), "event_id")
    for name, load in zip(("a", "b", "c", "b"), (*loads, loads[1])):
        table.merge(name, load)
    return table.read()


def user_index_incremental(spark, sf):
    dictionary = None
    for load in _loads(derive.r1_raw(spark, sf), "event_id"):
        dictionary = I.extend_dictionary(dictionary, load, "user_id", "user_idx")
    return dictionary


def dataset_summary_merged(spark, sf):
    states = [reliable_checkpoint(I.distinct_state(load, ["user_id", "movie_id"])) for load in _loads(C.r1_clean(spark, sf), "user_id")]
    return _round(I.summary_of(I.merge_distinct(*states)))


def error_percentiles_merged(spark, sf):
    errors = reliable_checkpoint(C.scored_val(spark, sf).select("movie_id", F.abs(F.col("rating") - F.col("prediction")).alias("error")))
    states = [reliable_checkpoint(I.quantile_state(load, "error")) for load in _loads(errors, "movie_id")]
    return _round(I.quantiles_of(reliable_checkpoint(I.merge_quantiles(*states)), errors, "error", E.PERCENTILES))


def run_log(spark, sf):
    # Every run logged twice, by two writers
    sweep = reliable_checkpoint(T.runs_from_sweep(_swept(spark, sf)))
    runs = T.log_rows(sweep, "knn_sweep")
    path = f"{stage_folder(spark)}/log"
    for writer in range(2):
        T.RunLog(spark, path).append(runs, f"writer-{writer}")
    return _round(T.RunLog(spark, path).comparison("knn_sweep").drop("training_time"))


def run_comparison_round_trip(spark, sf):
    # The comparison file
    path = f"{stage_folder(spark)}/comparison"
    files.write_run_comparison(T.runs_from_sweep(_swept(spark, sf)), path)
    return _round(spark.read.option("header", True).schema("run_id string, k_value long, rmse double, mae double, coverage double, status string").csv(path))


def model_metadata(spark, sf):
    # M17's metadata document (S5, S6) and the model's own parameters (M4), as name and value
    folder = stage_folder(spark)
    cells = C.r1_cells(spark, sf)
    W.train(spark, cells, cells, tune=True, output=f"{folder}/run")
    meta = files.read_json_dict(spark, f"{folder}/run/metadata")
    stored = store.load_model(f"{folder}/run/model", spark).config()
    values = {"k": stored["k"], "use_similarity_weights": stored["use_similarity_weights"], "default_rating": stored["default_rating"],
              "n_train": meta["training"]["n_train"], "n_val": meta["training"]["n_val"], "train_share": meta["split"]["train_share"],
              "rmse": meta["evaluation"]["rmse"], "mae": meta["evaluation"]["mae"]}
    return _round(spark.createDataFrame([(k, float(v)) for k, v in values.items()], "name string, value double"))


def structural_checks(spark, sf):
    # V1-V3 as rows: what the ingest asks of a table before it reads it
    raw = derive.r1_raw(spark, sf)
    found = [("raw", raw), ("ratings", raw.select(*RATING_COLUMNS)), ("no_timestamp", raw.drop("timestamp", "event_id")),
             ("none_over_five", raw.select(*RATING_COLUMNS).where("rating > 100"))]
    return spark.createDataFrame([(name, Q.has_exact_columns(df), not Q.missing_columns(df, RATING_COLUMNS), not df.isEmpty()) for name, df in found],
                                 "name string, exact_columns boolean, required_columns boolean, non_empty boolean")


def similar_users_pruned(spark, sf):
    # F7 where each cell passes on only pairs that reach their user's floor
    cells = C.r2_cells(spark, sf)
    return Fe.similar_users_pruned(cells, 5)


def similar_users_candidates(spark, sf):
    cells = C.r2_cells(spark, sf)
    return Fe.pruning_counts(cells, 5)


def matrix_blocks(spark, sf):
    # F2 for a catalogue over the pivot's limit: the cells that the blocks hold
    return Fe.cells_of_blocks(*Fe.matrix_blocks(C.r2_cells(spark, sf)))


def user_vector_lookup(spark, sf):
    # F8 for one user, from the store that holds all of them
    cells = C.r1_cells(spark, sf)
    path = f"{stage_folder(spark)}/vectors"
    store.save_vectors(Fe.user_vectors(cells), path)
    return store.lookup_scan(spark, path, cells.agg(F.min("user_id")).first()[0])


def gen_ratings(spark, sf):
    return synthetic.ratings_from_rows(derive.table(spark, sf, "events").select("event_id"))


QUERIES: dict[str, Query] = {name: fn for name, fn in list(globals().items())
                             if callable(fn) and getattr(fn, "__module__", None) == __name__
                             and not name.startswith("_")}
