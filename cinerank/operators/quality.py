"""Validation, predicates and cleaning (the ingest side).

Every check is a column expression; counts come from one conditional
aggregate per report, so a report costs one scan with map-side partial
aggregation whatever the table size.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import is_missing, to_double, to_long_truncating, with_scalars
from ..schema import (EXPECTED_METRICS, RATING_RULES, SIMPLE_RANGE, SOFT_RANGE,
                      ColumnRule, wide_id_rules)

# Texts of the validation report.
DTYPE_ERROR = "Datatype conversion failed"
COLUMNS_ERROR = "Missing required columns"


# --- V1-V3: structural checks (schema only, no Spark job) --------------------

def has_exact_columns(df: DataFrame, rules=RATING_RULES) -> bool:
    """V1: the column set equals the rule set (extra or missing both fail)."""
    return set(df.columns) == {r.name for r in rules}


def missing_columns(df: DataFrame, required) -> list[str]:
    """V2: the required columns that ``df`` hasn't; extra columns are fine."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required) -> None:
    """V2: required subset must be present."""
    if missing := missing_columns(df, required):
        raise ValueError(f"Missing columns: {missing}")


def require_non_empty(df: DataFrame) -> None:
    """V3."""
    if df.isEmpty():
        raise ValueError("ratings DataFrame is empty")


# --- V4: type coercion -------------------------------------------------------

def coerce_types(df: DataFrame, rules=RATING_RULES) -> DataFrame:
    """Cast each rule column to its type the way pandas ``to_numeric`` +
    ``astype`` would: unparsable text -> null, ints truncate ('3.7' -> 3).
    Other columns pass through.  Whether an int null aborts is decided by
    :func:`coercion_errors` / :func:`validation_report`."""
    out = df
    for r in rules:
        src = F.col(r.name)
        typed = to_long_truncating(src) if r.dtype == "int64" else to_double(src)
        out = out.withColumn(r.name, typed)
    return out


def _int_failures(rules) -> Column:
    ints = [F.col(r.name).isNull() for r in rules if r.dtype == "int64"]
    return reduce(lambda a, b: a | b, ints) if ints else F.lit(False)


def coercion_errors(coerced: DataFrame, rules=RATING_RULES) -> DataFrame:
    """V4 counts: one row with ``<col>_errors`` (null/NaN after coercion) per
    rule column, ``dtype_errors`` (their sum) and ``aborted`` (an int column
    had a null, which makes the reference give up)."""
    aggs = [F.count_if(is_missing(r.name) if r.dtype == "float64" else F.col(r.name).isNull())
            .cast("bigint").alias(f"{r.name}_errors") for r in rules]
    aggs.append(F.count_if(_int_failures(rules)).cast("bigint").alias("_int_fail"))
    row = coerced.agg(*aggs)
    total = reduce(lambda a, b: a + b, [F.col(f"{r.name}_errors") for r in rules])
    return row.select(*[f"{r.name}_errors" for r in rules],
                      total.alias("dtype_errors"),
                      (F.col("_int_fail") > 0).alias("aborted"))


# --- V5, V6: ranges and nulls ------------------------------------------------

def _in_range(r: ColumnRule) -> Column:
    # Both bounds inclusive; null and NaN are out of range (NaN sorts above all).
    c = F.col(r.name)
    return F.coalesce(c >= F.lit(r.lo) if r.hi is None else c.between(F.lit(r.lo), F.lit(r.hi)), F.lit(False))


def range_filter(df: DataFrame, rules=RATING_RULES) -> DataFrame:
    """V5: keep rows whose rule columns are all inside the inclusive bounds."""
    return df.where(reduce(lambda a, b: a & b, [_in_range(r) for r in rules]))


def first_failed_rule(rules=RATING_RULES) -> Column:
    """Name of the first rule (in schema order) a row violates, else null —
    the reference filters column by column, so a row counts only once, at the
    first column that removes it."""
    expr = None
    for r in rules:
        cond = ~_in_range(r)
        expr = F.when(cond, F.lit(r.name)) if expr is None else expr.when(cond, F.lit(r.name))
    return expr


def range_violations(df: DataFrame, rules=RATING_RULES) -> DataFrame:
    """V5 counts: (position, column_name, invalid) per rule, invalid counted on
    the rows that survived the earlier rules; zero rows included."""
    counts = df.agg(*[F.count_if(first_failed_rule(rules) == r.name).cast("bigint")
                      .alias(f"c{i}") for i, r in enumerate(rules)])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).cast("bigint").alias("position"),
                 F.lit(r.name).alias("column_name"),
                 F.col(f"c{i}").alias("invalid"))
        for i, r in enumerate(rules)])).alias("v")).select("v.*")


def drop_nulls(df: DataFrame, rules=RATING_RULES) -> DataFrame:
    """V6: drop rows null (or NaN) in any non-nullable rule column."""
    checks = [~is_missing(r.name) if r.dtype == "float64" else F.col(r.name).isNotNull()
              for r in rules if not r.nullable]
    return df.where(reduce(lambda a, b: a & b, checks)) if checks else df


# --- V7: full validation ----------------------------------------------------

def row_is_valid(rules=RATING_RULES) -> Column:
    """True when a coerced row passes the range and null rules (V5 + V6)."""
    in_all = reduce(lambda a, b: a & b, [_in_range(r) for r in rules])
    not_null = reduce(lambda a, b: a & b, [
        (~is_missing(r.name) if r.dtype == "float64" else F.col(r.name).isNotNull())
        for r in rules if not r.nullable])
    return in_all & not_null


def validated_rows(coerced: DataFrame, rules=RATING_RULES) -> DataFrame:
    """Rows kept by V7 after coercion: range filter then null filter."""
    return drop_nulls(range_filter(coerced, rules), rules)


def validation_report(raw: DataFrame, rules=RATING_RULES) -> DataFrame:
    """V7 report, one row: total_errors, dtype_errors, range_violations,
    null_violations, rows_retained, error.

    Reproduces the reference's accounting: a bad float is counted as a dtype
    error *and* as a range violation (NaN fails the range mask), so
    null_violations stays 0; an int coercion failure aborts the whole report
    (all counts null, ``error`` set).  One scan, one aggregate.
    """
    if not has_exact_columns(raw, rules):
        return raw.sparkSession.createDataFrame(
            [(None, None, None, None, None, COLUMNS_ERROR)], _REPORT_SCHEMA)
    return report_row(coerce_types(raw, rules).agg(*report_counts(rules)))


def report_counts(rules=RATING_RULES) -> list[Column]:
    """The counts behind V7's report, over coerced rows: for one aggregate, or for
    ``observe`` while the rows are written."""
    dtype_err = reduce(lambda a, b: a + b, [
        F.count_if(is_missing(r.name) if r.dtype == "float64" else F.col(r.name).isNull())
        for r in rules])
    in_all = reduce(lambda a, b: a & b, [_in_range(r) for r in rules])
    not_null = reduce(lambda a, b: a & b, [
        (~is_missing(r.name) if r.dtype == "float64" else F.col(r.name).isNotNull())
        for r in rules if not r.nullable])
    return [
        dtype_err.cast("bigint").alias("dtype_errors"),
        F.count_if(~in_all).cast("bigint").alias("range_violations"),
        F.count_if(in_all & ~not_null).cast("bigint").alias("null_violations"),
        F.count_if(in_all & not_null).cast("bigint").alias("rows_retained"),
        F.count_if(_int_failures(rules)).cast("bigint").alias("_int_fail"),
    ]


def report_row(counts: DataFrame) -> DataFrame:
    """V7's report from one row of :func:`report_counts`."""
    ok = F.col("_int_fail") == 0
    return counts.select(
        F.when(ok, F.col("dtype_errors") + F.col("range_violations") + F.col("null_violations"))
        .alias("total_errors"),
        *[F.when(ok, F.col(n)).alias(n) for n in
          ("dtype_errors", "range_violations", "null_violations", "rows_retained")],
        F.when(~ok, F.lit(DTYPE_ERROR)).alias("error"),
    )


_REPORT_SCHEMA = ("total_errors bigint, dtype_errors bigint, range_violations bigint, "
                  "null_violations bigint, rows_retained bigint, error string")


# --- V8-V10: the lighter checks of the other pipelines -----------------------

def rating_filter(df: DataFrame, lo: float = SIMPLE_RANGE[0], hi: float = SIMPLE_RANGE[1]) -> DataFrame:
    """V8: keep ratings in [lo, hi] (inclusive)."""
    return df.where(F.col("rating").between(lo, hi))


def soft_range_count(df: DataFrame, lo: float = SOFT_RANGE[0], hi: float = SOFT_RANGE[1]) -> DataFrame:
    """V9: how many ratings fall outside [lo, hi] (a warning, nothing removed)."""
    r = F.col("rating")
    # NaN compares false in pandas; Spark orders NaN above everything.
    return df.agg(F.count_if(~F.isnan(r) & ((r < lo) | (r > hi))).cast("bigint").alias("n_outside"),
                  F.count(F.lit(1)).cast("bigint").alias("n_rows"))


def null_columns(df: DataFrame, columns=None) -> DataFrame:
    """Per column, how many nulls (NaN included for doubles) and whether
    any — the reference raises when any column has one."""
    columns = list(columns or df.columns)
    dtypes = dict(df.dtypes)

    def miss(c):
        return is_missing(c) if dtypes[c] in ("double", "float") else F.col(c).isNull()

    counts = df.agg(*[F.count_if(miss(c)).cast("bigint").alias(f"n{i}")
                      for i, c in enumerate(columns)])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"),
                 (F.col(f"n{i}") > 0).alias("has_nulls"))
        for i, c in enumerate(columns)])).alias("v")).select("v.*")


def assert_no_nulls(df: DataFrame, columns=None) -> None:
    bad = [r.column_name for r in null_columns(df, columns).where("has_nulls").collect()]
    if bad:
        raise ValueError(f"missing values in {bad}")


# --- V11, V12: deduplication -------------------------------------------------

def dedup_latest(df: DataFrame, order_cols=("timestamp",), keys=("user_id", "movie_id")) -> DataFrame:
    """One row per (user, movie), the one latest by ``order_cols``
    (descending, a total order when tie-break columns are given).

    ``max_by`` is a hash aggregate: partial aggregation collapses duplicates
    map-side, so a hot (user, movie) key never reaches one task in bulk.
    """
    other = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in other]), order).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in other])


def dedup_first(df: DataFrame, order_cols=("event_id",), keys=("user_id", "movie_id")) -> DataFrame:
    """Keep the first row per (user, movie) in file order (``order_cols``
    ascending), never an arbitrary one."""
    other = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in other]), order).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in other])


# --- V13, V14: summaries and expectations ------------------------------------

def dataset_summary(df: DataFrame) -> DataFrame:
    """Rows, distinct users and movies, sparsity in percent."""
    s = df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
               F.count_distinct("user_id").cast("bigint").alias("n_users"),
               F.count_distinct("movie_id").cast("bigint").alias("n_movies"))
    return s.withColumn("sparsity_pct",
                        (F.lit(1.0) - F.col("n_rows") / (F.col("n_users") * F.col("n_movies"))) * 100)


def expectations(raw: DataFrame, clean: DataFrame, expected=EXPECTED_METRICS) -> DataFrame:
    """The reference declares these metrics but never checks them; here
    each is a row (metric, actual, expected, passed), all "at least"."""
    r = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    c = clean.agg(F.count(F.lit(1)).alias("clean_rows"),
                  F.count_distinct("user_id").alias("u"),
                  F.count_distinct("movie_id").alias("m"))
    both = with_scalars(r, c)
    sparsity = F.lit(1.0) - F.col("clean_rows") / (F.col("u") * F.col("m"))
    rows = [("raw_rows", F.col("raw_rows").cast("double"), expected["raw_rows"]),
            ("min_clean_rows", F.col("clean_rows").cast("double"), expected["min_clean_rows"]),
            ("target_sparsity", sparsity, expected["target_sparsity"])]
    return both.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric"), actual.alias("actual"),
                 F.lit(float(exp)).alias("expected"), (actual >= F.lit(exp)).alias("passed"))
        for name, actual, exp in rows])).alias("e")).select("e.*")


# --- V15, V16: the two ingest pipelines --------------------------------------

def fail_on_int_errors(raw: DataFrame, rules=RATING_RULES) -> DataFrame:
    """Q1: any int value that does not parse aborts the job with
    'Datatype conversion failed' — raised by the executors while the rows
    stream by (``raise_error`` in a filter), no separate counting pass.

    Applied to the raw rows, before deduplication, like the reference's typed
    read: placed after the dedup, Catalyst would push the later range filter
    on the grouping keys below the aggregate and drop the bad rows unseen."""
    bad = reduce(lambda a, b: a | b, [to_long_truncating(F.col(r.name)).isNull()
                                      for r in rules if r.dtype == "int64"])
    return raw.where(F.when(bad, F.raise_error(F.lit(DTYPE_ERROR))).isNull())


def ingest_strict(raw: DataFrame, order_cols=("timestamp",), rules=RATING_RULES,
                  keep=None, on_int_error: str = "fail",
                  observe: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Type the rows, dedup (latest), then range + null checks.  Typing
    comes first, so that times and ids compare as numbers (text '978300000' is
    older than '1100000000', and '1', '01' and '1.0' are one id); validation comes
    last, so that an invalid latest rating evicts a valid older one.

    ``on_int_error``: 'fail' (the reference: an unparsable int aborts the
    whole ingest) or 'drop' (such rows are removed with the range rules).
    ``raw`` may carry tie-break columns (``order_cols``); the result keeps the
    rule columns plus ``keep``.  ``observe`` may count the deduplicated rows on
    their way; it stands after the last shuffle, so that tasks run again don't count
    twice.
    """
    if on_int_error not in ("fail", "drop"):
        raise ValueError("on_int_error must be 'fail' or 'drop'")
    if on_int_error == "fail":
        raw = fail_on_int_errors(raw, rules)
    latest = dedup_latest(coerce_types(raw, rules), order_cols)
    clean = validated_rows(observe(latest) if observe else latest, rules)
    return clean.select(*[r.name for r in rules], *(keep or []))


def ingest_simple(raw: DataFrame, order_cols=("event_id",), lo: float = SIMPLE_RANGE[0],
                  hi: float = SIMPLE_RANGE[1]) -> DataFrame:
    """Required columns, rating in [1, 5], then keep-first dedup —
    validation precedes dedup here."""
    require_columns(raw, ("user_id", "movie_id", "rating", "timestamp"))
    return dedup_first(rating_filter(raw, lo, hi), order_cols)


# --- V17: request rules ------------------------------------------------------

def valid_requests(df: DataFrame) -> DataFrame:
    """Prediction requests need user_id > 0 and movie_id > 0."""
    return df.where((F.col("user_id") > 0) & (F.col("movie_id") > 0))


def check_request_args(n: int | None = None, k: int | None = None) -> None:
    """V17 argument bounds: 1 <= n <= 50 recommendations, 1 <= k <= 20 users."""
    if n is not None and not 1 <= n <= 50:
        raise ValueError("n must be in [1, 50]")
    if k is not None and not 1 <= k <= 20:
        raise ValueError("k must be in [1, 20]")


def clean_ratings(raw: DataFrame, order_cols, rules=None) -> DataFrame:
    """The standard cleaned table used by the features and the model:
    latest rating per pair, inside the rating/timestamp rules, ids unbounded."""
    rules = rules or wide_id_rules()
    return range_filter(dedup_latest(raw, order_cols), rules).select(
        *[r.name for r in rules])

