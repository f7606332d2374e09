"""Evaluation (E1-E11) over a scored table (user_id, movie_id, rating,
prediction): predictions are made once and every metric is an aggregate of
that table.  Medians and percentiles are exact (see ``exact_quantiles``);
everything else is a single conditional aggregate with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import with_scalars
from ..functions.ranking import exact_quantiles
from ..schema import (COVERAGE_GOOD, COVERAGE_MODERATE, COVERAGE_THRESHOLD, DEFAULT_RATING,
                      ENGAGEMENT_LOW_MAX, ENGAGEMENT_MEDIUM_MAX, ERROR_BINS)

PERCENTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95}


def _err(scored: DataFrame) -> DataFrame:
    return scored.withColumn("error", F.abs(F.col("rating") - F.col("prediction")))


def rating_metrics(scored: DataFrame, error_quantiles: DataFrame | None = None) -> DataFrame:
    """Rmse, mae, median/mean/population-std/min/max of |error|, n.
    ``error_quantiles``: a precomputed :func:`error_percentiles` row (its p50
    is the median) so a report ranks the errors once."""
    s = _err(scored)
    e = F.col("error")
    m = s.agg(F.sqrt(F.avg(e * e)).alias("rmse"),
              F.avg(e).alias("mae"),
              F.avg(e).alias("mean_error"),
              F.stddev_pop(e).alias("std_error"),
              F.min(e).alias("min_error"),
              F.max(e).alias("max_error"),
              F.count(F.lit(1)).cast("bigint").alias("n_samples"))
    if error_quantiles is not None:
        return with_scalars(m, error_quantiles.select(F.col("p50").alias("median_error")))
    med = exact_quantiles(s, "error", {"median_error": 0.5})
    return with_scalars(m, med)


def error_percentiles(scored: DataFrame) -> DataFrame:
    """|error| percentiles 25/50/75/90/95, linear interpolation."""
    q = exact_quantiles(_err(scored), "error", PERCENTILES)
    return q


def catalog_coverage(scored: DataFrame, threshold: float = COVERAGE_THRESHOLD) -> DataFrame:
    """Share of test movies with at least one test pair predicted at or
    above ``threshold``."""
    per_movie = scored.groupBy("movie_id").agg(F.max("prediction").alias("_best"))
    c = per_movie.agg(F.count_if(F.col("_best") >= threshold).cast("bigint").alias("n_recommended"),
                      F.count(F.lit(1)).cast("bigint").alias("n_total"))
    return c.select((F.col("n_recommended") / F.col("n_total")).alias("coverage_ratio"),
                    "n_recommended", "n_total",
                    F.lit(float(threshold)).alias("recommendation_threshold"))


def coverage_verdict(coverage: DataFrame) -> DataFrame:
    """> 0.8 good, > 0.5 moderate, else low."""
    r = F.col("coverage_ratio")
    return coverage.withColumn("verdict", F.when(r > COVERAGE_GOOD, "good")
                               .when(r > COVERAGE_MODERATE, "moderate").otherwise("low"))


def sparsity(ratings: DataFrame, n_movies: int | None = None) -> DataFrame:
    """E5: users (distinct in ratings), movies (given, else distinct), rating
    rows, possible cells, density, sparsity."""
    movies = F.lit(n_movies).cast("bigint") if n_movies is not None else \
        F.count_distinct("movie_id").cast("bigint")
    s = ratings.agg(F.count_distinct("user_id").cast("bigint").alias("n_users"),
                    movies.alias("n_movies"),
                    F.count(F.lit(1)).cast("bigint").alias("n_ratings"))
    s = s.withColumn("max_possible", F.col("n_users") * F.col("n_movies"))
    d = F.col("n_ratings") / F.col("max_possible")
    return s.select("*", d.alias("density"), (1 - d).alias("sparsity"))


def ratings_per_stats(ratings: DataFrame, key: str) -> DataFrame:
    """Mean, median, min, max of the number of ratings per ``key``."""
    per = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    s = per.agg(F.avg("n").alias("mean"),
                F.min("n").cast("bigint").alias("min"), F.max("n").cast("bigint").alias("max"))
    med = exact_quantiles(per, "n", {"median": 0.5})
    return with_scalars(s, med)


def error_histogram(scored: DataFrame) -> DataFrame:
    """(bin, lower, upper, count, percentage) for [0,.5) [.5,1) [1,1.5)
    [1.5,2) [2,5); empty bins present, errors >= 5 in no bin, percentage of
    all rows.  One aggregate with a conditional count per bin."""
    e = F.col("error")
    agg = _err(scored).agg(F.count(F.lit(1)).alias("_n"), *[
        F.count_if((e >= lo) & (e < hi)).alias(f"b{i}") for i, (lo, hi) in enumerate(ERROR_BINS)])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(f"error_{lo:.1f}_{hi:.1f}").alias("bin"), F.lit(lo).alias("lower"),
                 F.lit(hi).alias("upper"), F.col(f"b{i}").cast("bigint").alias("count"),
                 (F.col(f"b{i}") * 100.0 / F.col("_n")).alias("percentage"))
        for i, (lo, hi) in enumerate(ERROR_BINS)])).alias("b")).select("b.*")


def error_summary(scored: DataFrame) -> DataFrame:
    """E7 companion stats: mean, population std, min, max of |error|."""
    e = F.col("error")
    return _err(scored).agg(F.avg(e).alias("mean_error"),
                            F.stddev_pop(e).alias("std_error"),
                            F.min(e).alias("min_error"),
                            F.max(e).alias("max_error"))


def _baselines(mean, variance, median, neutral: float) -> list:
    """E8 columns from the ratings' mean, population variance and median: the mean
    squared distance to a constant is the variance plus its squared distance to
    the mean."""
    rmse = lambda c: F.sqrt(variance + (mean - c) ** 2)
    return [mean.alias("mean_value"), F.sqrt(variance).alias("mean_rmse"), median.alias("median_value"),
            rmse(median).alias("median_rmse"), F.lit(neutral).alias("neutral_value"), rmse(F.lit(neutral)).alias("neutral_rmse"),
            F.least(F.sqrt(variance), rmse(median), rmse(F.lit(neutral))).alias("best_baseline_rmse")]


def baselines(scored: DataFrame, neutral: float = DEFAULT_RATING) -> DataFrame:
    """RMSE of predicting always the mean, always the median and always
    3.0; best = the smallest."""
    moments = scored.agg(F.avg("rating").alias("_mean"), F.var_pop("rating").alias("_var"))
    both = with_scalars(moments, exact_quantiles(scored, "rating", {"_med": 0.5}))
    return both.select(*_baselines(F.col("_mean"), F.col("_var"), F.col("_med"), neutral))


def engagement_segments(scored: DataFrame) -> DataFrame:
    """MAE by the user's number of test rows (<= 5 low, 6-20 medium,
    > 20 high): segment, n_samples, mae, mean_engagement (row-weighted).
    Aggregated per user first, so a hot user is one pre-aggregated row —
    never a window holding all its rows."""
    per_user = _err(scored).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("error").alias("_se"))
    n = F.col("_n")
    seg = (F.when(n <= ENGAGEMENT_LOW_MAX, "low")
           .when(n <= ENGAGEMENT_MEDIUM_MAX, "medium").otherwise("high"))
    return per_user.groupBy(seg.alias("segment")).agg(
        F.sum("_n").cast("bigint").alias("n_samples"),
        (F.sum("_se") / F.sum("_n")).alias("mae"),
        (F.sum(n * n) / F.sum("_n")).alias("mean_engagement"))


def beats_baseline(metrics: DataFrame, base: DataFrame) -> DataFrame:
    """Model rmse < best baseline rmse."""
    return with_scalars(metrics.select("rmse"), base.select("best_baseline_rmse")).select(
        F.col("rmse").alias("model_rmse"), "best_baseline_rmse",
        (F.col("rmse") < F.col("best_baseline_rmse")).alias("beats_baseline"))


def evaluation_report(scored: DataFrame, ratings: DataFrame, metadata: dict | None = None,
                      n_movies: int | None = None, neutral: float = DEFAULT_RATING) -> DataFrame:
    """One row of nested structs - test_set, rating_prediction, coverage,
    sparsity, error_distribution, baselines, by_engagement (+ metadata as JSON
    text).  One aggregate gives the counts, the error statistics, the histogram
    and the ratings' moments; the quantiles, the movies, the users and the rating
    table need one each."""
    import json
    s = _err(scored)
    e = F.col("error")
    one = s.agg(F.count(F.lit(1)).cast("bigint").alias("_n"), F.sqrt(F.avg(e * e)).alias("_rmse"), F.avg(e).alias("_mae"),
                F.stddev_pop(e).alias("_std"), F.min(e).alias("_min"), F.max(e).alias("_max"),
                F.avg("rating").alias("_mean"), F.var_pop("rating").alias("_var"),
                *[F.count_if((e >= lo) & (e < hi)).cast("bigint").alias(f"_b{i}") for i, (lo, hi) in enumerate(ERROR_BINS)])
    pct = exact_quantiles(s, "error", PERCENTILES).select(F.struct(*PERCENTILES).alias("_pct"))
    med = exact_quantiles(scored, "rating", {"_med": 0.5})
    cov = coverage_verdict(catalog_coverage(scored)).select(F.struct("*").alias("coverage"))
    sp = sparsity(ratings, n_movies).select(F.struct("*").alias("sparsity"))
    seg = engagement_segments(scored).agg(F.sort_array(F.collect_list(F.struct("*"))).alias("by_engagement"))
    out = one
    for part in (pct, med, cov, sp, seg):
        out = with_scalars(out, part)
    c = F.col
    stats = [c("_mae").alias("mean_error"), c("_std").alias("std_error"), c("_min").alias("min_error"), c("_max").alias("max_error")]
    bins = F.array(*[F.struct(F.lit(f"error_{lo:.1f}_{hi:.1f}").alias("bin"), F.lit(lo).alias("lower"), F.lit(hi).alias("upper"),
                              c(f"_b{i}").alias("count"), (c(f"_b{i}") * 100.0 / c("_n")).alias("percentage"))
                     for i, (lo, hi) in enumerate(ERROR_BINS)])
    return out.select(
        F.struct(c("_n").alias("n_samples")).alias("test_set"),
        F.struct(c("_rmse").alias("rmse"), c("_mae").alias("mae"), *stats, c("_n").alias("n_samples"),
                 c("_pct.p50").alias("median_error"), c("_pct").alias("percentiles")).alias("rating_prediction"),
        "coverage", "sparsity", F.struct(*stats, bins.alias("bins")).alias("error_distribution"),
        F.struct(*_baselines(c("_mean"), c("_var"), c("_med"), neutral)).alias("baselines"), "by_engagement",
        F.lit(json.dumps(metadata or {}, default=str)).alias("metadata"))


def report_metrics(report: DataFrame) -> DataFrame:
    """E11 as rows (section, metric, value): every number of the report."""
    def entry(section, metric, value):
        return F.struct(F.lit(section).alias("section"), metric if not isinstance(metric, str) else F.lit(metric).alias("metric"),
                        value.cast("double").alias("value"))

    flat = {"test_set": ["n_samples"],
            "rating_prediction": ["rmse", "mae", "mean_error", "std_error", "min_error", "max_error", "n_samples", "median_error"],
            "coverage": ["coverage_ratio", "n_recommended", "n_total", "recommendation_threshold"],
            "sparsity": ["n_users", "n_movies", "n_ratings", "max_possible", "density", "sparsity"],
            "error_distribution": ["mean_error", "std_error", "min_error", "max_error"],
            "baselines": ["mean_value", "mean_rmse", "median_value", "median_rmse", "neutral_value", "neutral_rmse", "best_baseline_rmse"]}
    rows = [entry(s, m, F.col(f"{s}.{m}")) for s, names in flat.items() for m in names]
    rows += [entry("percentiles", p, F.col(f"rating_prediction.percentiles.{p}")) for p in PERCENTILES]
    rows += [entry("error_bins", f"error_{lo:.1f}_{hi:.1f}", F.col("error_distribution.bins")[i]["count"]) for i, (lo, hi) in enumerate(ERROR_BINS)]
    rows += [entry("baselines", "beats_baseline", F.col("rating_prediction.rmse") < F.col("baselines.best_baseline_rmse"))]
    segments = F.flatten(F.transform("by_engagement", lambda s: F.array(
        *[F.struct(F.concat(F.lit("engagement_"), s["segment"]).alias("section"), F.lit(m).alias("metric"), s[m].cast("double").alias("value"))
          for m in ("n_samples", "mae", "mean_engagement")])))
    return report.select(F.explode(F.concat(F.array(*rows), segments)).alias("r")).select("r.*")
