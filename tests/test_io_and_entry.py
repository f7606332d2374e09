"""Sources/sinks round trips, persistence, the run log, the synthetic
generator and the driver entry points."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cinerank.operators import features as Fe
from cinerank.operators import knn, tuning as T
from cinerank.plans import workflows as W
from cinerank.sources import files, store, synthetic

SF = "/root/testdata/sf0.001"


def write_text(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_tsv_loader(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ratings.tsv")
    write_text(p, "user_id\tmovie_id\trating\ttimestamp\n1\t10\t4.5\t978300000\n2\t20\t3.0\t978300001\n")
    df = files.read_ratings_tsv(spark, p)
    assert [tuple(r) for r in df.orderBy("user_id").collect()] == [(1, 10, 4.5, 978300000),
                                                                  (2, 20, 3.0, 978300001)]
    bad = os.path.join(tmp_dir, "bad.tsv")
    write_text(bad, "user_id\tmovie_id\trating\ttimestamp\nx\t10\t4.5\t978300000\n")
    with pytest.raises(Exception):
        files.read_ratings_tsv(spark, bad).collect()


def test_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        files.read_ratings_tsv(spark, "/nonexistent/ratings.csv")


def test_ratings_and_report_round_trip(spark, ratings, tmp_dir):
    df = ratings([(1, 10, 4.5, 978300000), (2, 20, 3.0, 978300001)])
    files.write_ratings(df, os.path.join(tmp_dir, "clean_csv"), fmt="csv")
    back = files.read_ratings_csv(spark, os.path.join(tmp_dir, "clean_csv"))
    assert back.count() == 2
    from cinerank.operators import quality as Q
    files.write_report(Q.validation_report(df), os.path.join(tmp_dir, "report"))
    assert files.read_report(spark, os.path.join(tmp_dir, "report")).first().rows_retained == 2
    files.write_json_dict(spark, {"k": 5, "w": False}, os.path.join(tmp_dir, "meta"))
    assert files.read_json_dict(spark, os.path.join(tmp_dir, "meta")) == {"k": 5, "w": False}


def test_feature_store_and_model(spark, tmp_dir):
    cells = spark.createDataFrame([(1, 1, 4.0), (2, 1, 3.0), (2, 2, 5.0)],
                                  "user_id long, movie_id long, rating double")
    store.save_features(cells, Fe.user_similarity(cells), os.path.join(tmp_dir, "fs"))
    assert store.load_cells(os.path.join(tmp_dir, "fs"), spark).count() == 3
    model = knn.fit(cells, cells, k=3)
    store.save_model(model, os.path.join(tmp_dir, "model"))
    back = store.load_model(os.path.join(tmp_dir, "model"), spark)
    assert back.config() == model.config() == {"model_type": "KNNRecommendation", "k": 3,
                                               "use_similarity_weights": False, "default_rating": 3.0}
    with pytest.raises(TypeError):
        store.load_cells(os.path.join(tmp_dir, "model"), spark)
    pred = back.predict(spark.createDataFrame([(1, 2)], "user_id long, movie_id long")).first()
    assert pred.prediction == 5.0


def test_run_log_and_leaderboard(spark, tmp_dir):
    log = T.RunLog(spark, os.path.join(tmp_dir, "runs"))
    rows = [{"k": 3, "rmse": 0.5, "mae": 0.4, "coverage": 1.0, "status": "completed"},
            {"k": 5, "rmse": 0.45, "mae": 0.35, "coverage": 1.0, "status": "completed"}]
    T.log_sweep(log, rows, "exp", 0.01)
    lb = log.comparison("exp").orderBy("leaderboard_rank").collect()
    assert [r.k_value for r in lb] == [5, 3]
    files.write_run_comparison(log.comparison("exp"), os.path.join(tmp_dir, "cmp"))


def test_synthetic_generator(spark):
    df = synthetic.generate_ratings(spark, 2000)
    s = df.agg(F.min("user_id"), F.max("user_id"), F.min("rating"), F.max("rating"),
               F.min("timestamp"), F.max("timestamp"), F.avg("rating")).first()
    assert 1 <= s[0] and s[1] <= 189 and s[2] >= 1.0 and s[3] <= 5.0
    assert synthetic.TS_START <= s[4] and s[5] < synthetic.TS_END
    assert 3.2 < s[6] < 3.7
    again = synthetic.generate_ratings(spark, 2000)
    assert df.exceptAll(again).count() == 0


def test_prepare_features_and_train(spark, tmp_dir):
    from cinerank.plans import context as C
    clean = C.r1_clean(spark, SF)
    cells, sims, stats, lookups = W.prepare_features(clean, os.path.join(tmp_dir, "features"))
    assert stats["n_rated"] == cells.count()
    assert lookups.select("user_id").distinct().count() <= 3
    res = W.train(spark, cells, clean, tune=True)
    rep = res.report.first()
    assert rep.k in (3, 5, 10, 15, 20) and rep.n_train + rep.n_val == clean.count()


def test_entry_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 75                       # 15 users x 5
    assert df.columns == ["user_id", "movie_id", "predicted_rating", "rank"]
    assert all(0.5 <= r.predicted_rating <= 5.0 for r in rows)


def test_registry_has_oracles():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    from cinerank.plans.queries import QUERIES
    assert set(QUERIES) <= set(q) and set(QUERIES) - set(o) == {"evaluation_report"}


def test_cluster_conf_sizes_partitions():
    from cinerank.session import cluster_conf
    small = cluster_conf(1 << 30, 64)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 64
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_empty_report_writes_nothing(spark, tmp_dir):
    empty = spark.createDataFrame([], "total_errors long")
    with pytest.warns(UserWarning):
        assert files.write_report(empty, os.path.join(tmp_dir, "none")) is False
    assert not os.path.exists(os.path.join(tmp_dir, "none"))


def test_comma_reader_and_parquet_writer(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ratings.csv")
    write_text(p, "user_id,movie_id,rating,timestamp\n1,10,4.5,978300000\n1,10,3.5,978300005\n")
    df = files.read_ratings_csv(spark, p)
    assert df.count() == 2 and dict(df.dtypes)["rating"] == "double"
    text = files.read_ratings_text(spark, p)
    assert dict(text.dtypes)["user_id"] == "string"
    out = os.path.join(tmp_dir, "clean_parquet")
    files.write_ratings(W.ingest_simple(df.withColumn("event_id", F.monotonically_increasing_id())), out)
    back = spark.read.parquet(out).collect()
    assert [(r.user_id, r.movie_id, r.rating) for r in back] == [(1, 10, 4.5)]
