"""Ingest and validation: the reference's unit tests plus one edge row per quirk."""

import pytest
from pyspark.sql import functions as F

from cinerank.operators import quality as Q
from cinerank.schema import string_schema

VALID = [(1, 10, 4.5, 978300000), (2, 20, 3.0, 978300001), (3, 30, 5.0, 978300002)]
TEXT = "user_id string, movie_id string, rating string, timestamp string"


def test_valid_columns(ratings):
    assert Q.has_exact_columns(ratings(VALID))


def test_missing_column(spark):
    df = spark.createDataFrame([(1, 1, 4.0)], "user_id long, movie_id long, rating double")
    assert not Q.has_exact_columns(df)
    with pytest.raises(ValueError):
        Q.require_columns(df, ["user_id", "movie_id", "rating", "timestamp"])


def test_extra_column_exact_fails_subset_passes(spark):
    df = spark.createDataFrame([(1, 1, 4.0, 978300000, "x")],
                               "user_id long, movie_id long, rating double, timestamp long, extra string")
    assert not Q.has_exact_columns(df)
    Q.require_columns(df, ["user_id", "movie_id", "rating", "timestamp"])


def test_datatypes_no_errors(ratings):
    c = Q.coerce_types(ratings(VALID))
    row = Q.coercion_errors(c).first()
    assert row["dtype_errors"] == 0 and not row["aborted"]
    assert dict(c.dtypes)["user_id"] == "bigint"


def test_ranges_keep_all(ratings):
    df = ratings(VALID)
    assert Q.range_filter(df).count() == 3
    assert [r.invalid for r in Q.range_violations(df).orderBy("position").collect()] == [0, 0, 0, 0]


def test_inclusive_bounds(ratings):
    df = ratings([(1, 1, 0.5, 978300000), (1, 2, 5.0, 978300000),
                  (1, 3, 0.49, 978300000), (1, 4, 5.01, 978300000)])
    assert sorted(r.rating for r in Q.range_filter(df).collect()) == [0.5, 5.0]


def test_bad_float_counted_twice(spark):
    df = spark.createDataFrame([("1", "1", "n/a", "978300000"), ("2", "2", "4.0", "978300000")], TEXT)
    rep = Q.validation_report(df).first()
    assert (rep.dtype_errors, rep.range_violations, rep.null_violations, rep.total_errors,
            rep.rows_retained, rep.error) == (1, 1, 0, 2, 1, None)


def test_bad_int_aborts(spark):
    df = spark.createDataFrame([("x", "1", "4.0", "978300000"), ("2", "2", "4.0", "978300000")], TEXT)
    rep = Q.validation_report(df).first()
    assert rep.error == "Datatype conversion failed"
    assert rep.total_errors is None and rep.rows_retained is None


def test_int_truncates_and_suffixes_rejected(spark):
    df = spark.createDataFrame([("3.7", "1", "4f", "978300000")], TEXT)
    row = Q.coerce_types(df).first()
    assert row.user_id == 3 and row.rating is None


def test_missing_columns_report(spark):
    df = spark.createDataFrame([(1, 1, 4.0)], "user_id long, movie_id long, rating double")
    assert Q.validation_report(df).first().error == "Missing required columns"


def test_dedup_before_validation(ratings):
    t = 978300000
    df = ratings([(1, 1, 4.0, t), (1, 1, 9.0, t + 1)])
    assert Q.ingest_strict(df).count() == 0                  # latest (invalid) evicts valid
    kept = Q.ingest_simple(df.withColumn("event_id", F.monotonically_increasing_id()))
    assert [r.rating for r in kept.collect()] == [4.0]       # validation first keeps 4.0


def test_dedup_first_vs_latest(spark):
    t = 978300000
    rows = [(1, 1, 4.0, t + 1, 0), (1, 1, 2.0, t, 1)]
    schema = "user_id long, movie_id long, rating double, timestamp long, event_id long"
    df = spark.createDataFrame(rows, schema)
    assert Q.dedup_first(df, ("event_id",)).first().rating == 4.0
    assert Q.dedup_latest(df, ("timestamp",)).first().rating == 4.0
    rev = spark.createDataFrame([(1, 1, 2.0, t, 0), (1, 1, 4.0, t + 1, 1)], schema)
    assert Q.dedup_first(rev, ("event_id",)).first().rating == 2.0
    assert Q.dedup_latest(rev, ("timestamp",)).first().rating == 4.0


def test_soft_range_and_null_columns(spark):
    df = spark.createDataFrame([(1, 1, 6.0, 1), (1, 2, None, 1), (1, 3, float("nan"), 1)],
                               "user_id long, movie_id long, rating double, timestamp long")
    assert Q.soft_range_count(df).first().n_outside == 1
    nc = {r.column_name: r.null_count for r in Q.null_columns(df).collect()}
    assert nc == {"user_id": 0, "movie_id": 0, "rating": 2, "timestamp": 0}
    with pytest.raises(ValueError):
        Q.assert_no_nulls(df)


def test_valid_requests_and_args(spark):
    df = spark.createDataFrame([(1, 0), (0, 1), (2, 3)], "user_id long, movie_id long")
    assert [tuple(r) for r in Q.valid_requests(df).collect()] == [(2, 3)]
    with pytest.raises(ValueError):
        Q.check_request_args(n=0)
    with pytest.raises(ValueError):
        Q.check_request_args(k=21)
    Q.check_request_args(n=50, k=20)


def test_string_schema():
    assert [f.name for f in string_schema()] == ["user_id", "movie_id", "rating", "timestamp"]


def test_strict_ingest_aborts_on_bad_int(spark):
    df = spark.createDataFrame([("x", "1", "4.0", "978300000"), ("2", "2", "4.0", "978300000")], TEXT)
    with pytest.raises(Exception, match="Datatype conversion failed"):
        Q.ingest_strict(df).collect()
    kept = Q.ingest_strict(df, on_int_error="drop").collect()
    assert [(r.user_id, r.movie_id) for r in kept] == [(2, 2)]
    with pytest.raises(ValueError):
        Q.ingest_strict(df, on_int_error="ignore")


def test_strict_ingest_of_rdx_fails(spark):
    from cinerank.sources import derive
    rdx = derive.rd_raw(spark, "/root/testdata/sf0.001", bad_user_ids=True)
    with pytest.raises(Exception, match="Datatype conversion failed"):
        Q.ingest_strict(rdx, ("timestamp", "event_id")).count()
    rd = derive.rd_raw(spark, "/root/testdata/sf0.001")
    assert Q.ingest_strict(rd, ("timestamp", "event_id")).count() > 0
