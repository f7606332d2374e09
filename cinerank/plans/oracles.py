"""DuckDB oracles: for each registered query, an independent SQL statement
over the driver's tables with the same output columns.

The oracles use the plain (dense, self-join, row-at-a-time-ranking)
definitions on purpose — the Spark plans take other routes to the same
answer (block products, padding from bounded id lists, sparse candidate sets),
so agreement checks those routes.
"""

from __future__ import annotations

NUMERIC = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
K = 5
K_LIST = (3, 5, 10, 15, 20)


def _bucket(*cols: str, seed: int = 42) -> str:
    return (f"(('0x' || substr(md5(concat_ws(':', {', '.join(cols)}, '{seed}')), 1, 8))::BIGINT % 100)")


def _hash32(*cols: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(cols)}, '{seed}')), 1, 8))::BIGINT"


def _in(col: str, lo, hi) -> str:
    return f"coalesce({col} >= {lo}, false)" if hi is None else f"coalesce({col} BETWEEN {lo} AND {hi}, false)"


REF_RULES = (("user_id", 1, 1000), ("movie_id", 1, 1700), ("rating", 0.5, 5.0),
             ("timestamp", 700000000, 2000000000))
WIDE_RULES = (("user_id", 1, None), ("movie_id", 1, None), ("rating", 0.5, 5.0),
              ("timestamp", 700000000, 2000000000))


def _all_in(rules=REF_RULES) -> str:
    return " AND ".join(_in(c, lo, hi) for c, lo, hi in rules)


# --- derivations ---------------------------------------------------------------------

R1_RAW = """r1_raw AS (
  SELECT user_id + 1 AS user_id, json_extract_string(props, '$.k')::BIGINT + 1 AS movie_id,
         CAST((floor(value / 10) + 1) * 0.5 AS DOUBLE) AS rating,
         CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, event_id
  FROM events)"""

R1 = R1_RAW + f""",
r1_dd AS (SELECT *, row_number() OVER (PARTITION BY user_id, movie_id
                                      ORDER BY timestamp DESC, event_id DESC) AS rn FROM r1_raw),
r1 AS (SELECT user_id, movie_id, rating, timestamp FROM r1_dd
       WHERE rn = 1 AND {_all_in(WIDE_RULES)})"""

R2 = f"""r2_raw AS (
  SELECT o_custkey + 1 AS user_id, l_partkey + 1 AS movie_id,
         CAST(floor(l_quantity / 5) * 0.5 AS DOUBLE) AS rating,
         CAST(floor(epoch(l_shipdate)) AS BIGINT) AS timestamp, l_orderkey, l_linenumber, l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
r2_dd AS (SELECT *, row_number() OVER (PARTITION BY user_id, movie_id
          ORDER BY timestamp DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn FROM r2_raw),
r2 AS (SELECT user_id, movie_id, rating, timestamp FROM r2_dd
       WHERE rn = 1 AND {_all_in(WIDE_RULES)})"""

RD = R1_RAW + """,
rd AS (SELECT CAST(user_id AS VARCHAR) AS user_id, movie_id,
              CASE WHEN event_id % 97 = 0 THEN 'n/a' WHEN event_id % 101 = 0 THEN NULL
                   ELSE CAST(rating AS VARCHAR) END AS rating, timestamp, event_id FROM r1_raw)"""

RDX = RD.replace("rd AS (SELECT CAST(user_id AS VARCHAR) AS user_id",
                 "rd AS (SELECT CASE WHEN event_id % 1009 = 0 THEN 'x' ELSE CAST(user_id AS VARCHAR) END AS user_id")


def _dbl(x: str) -> str:
    return (f"CASE WHEN regexp_matches(trim(CAST({x} AS VARCHAR)), '{NUMERIC}') "
            f"THEN TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE) END")


def _lng(x: str) -> str:
    s = f"trim(CAST({x} AS VARCHAR))"
    whole = f"regexp_replace({s}, '[.].*$', '')"
    return (f"CASE WHEN regexp_matches({s}, '^[+-]?[0-9]+$') THEN TRY_CAST({s} AS BIGINT) "
            f"WHEN regexp_matches({s}, '^[+-]?([0-9]+[.][0-9]*|[.][0-9]+)$') "
            f"THEN CASE WHEN {whole} IN ('', '+', '-') THEN 0 ELSE TRY_CAST({whole} AS BIGINT) END "
            f"ELSE TRY_CAST(trunc({_dbl(x)}) AS BIGINT) END")


def _coerced(src: str, name: str) -> str:
    return (f"{name} AS (SELECT {_lng('user_id')} AS user_id, {_lng('movie_id')} AS movie_id, "
            f"{_dbl('rating')} AS rating, {_lng('timestamp')} AS timestamp, event_id FROM {src})")


RT = R1_RAW + """,
rd AS (SELECT CASE event_id % 3 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN '0' || CAST(user_id AS VARCHAR)
              ELSE CAST(user_id AS VARCHAR) || '.0' END AS user_id,
              CASE WHEN event_id % 11 = 0 THEN CAST(movie_id + 9007199254740993 AS VARCHAR) ELSE ' ' || CAST(movie_id AS VARCHAR) END AS movie_id,
              CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(rating AS VARCHAR) END AS rating,
              CASE WHEN event_id % 5 < 2 THEN CAST(timestamp - 900000000 AS VARCHAR) ELSE CAST(timestamp AS VARCHAR) END AS timestamp,
              event_id FROM r1_raw)"""

RDC = RD + ",\n" + _coerced("rd", "rdc")
RTC = RT + ",\n" + _coerced("rd", "rdc")
RDXC = RDX + ",\n" + _coerced("rd", "rdc")

REQ = """req AS (SELECT event_id, user_id, json_extract_string(props, '$.k')::BIGINT AS movie_id FROM events)"""


def cells_of(src: str, name: str = "cells") -> str:
    return (f"{name} AS (SELECT user_id, movie_id, avg(rating) AS rating FROM {src} "
            f"GROUP BY user_id, movie_id HAVING avg(rating) IS NOT NULL AND avg(rating) <> 0)")


def sims_of(cells: str = "cells", name: str = "sim") -> str:
    return f"""{name}_q AS (SELECT user_id, movie_id, CAST(round(rating * 1000000) AS BIGINT) AS q FROM {cells}),
{name}_n2 AS (SELECT user_id, CAST(sum(q * q) AS DOUBLE) AS n2 FROM {name}_q GROUP BY user_id),
{name}_dp AS (SELECT a.user_id AS u, b.user_id AS v, CAST(sum(a.q * b.q) AS DOUBLE) AS dot
        FROM {name}_q a JOIN {name}_q b ON a.movie_id = b.movie_id AND a.user_id <> b.user_id GROUP BY 1, 2),
{name} AS (SELECT u AS user_id, v AS neighbor_id, dot / (sqrt(x.n2) * sqrt(y.n2)) AS similarity
        FROM {name}_dp JOIN {name}_n2 x ON x.user_id = u JOIN {name}_n2 y ON y.user_id = v WHERE dot > 0)"""


NB = """nb AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY similarity DESC, neighbor_id ASC) AS rank
        FROM sim)"""

SPLIT = f"""r1s AS (SELECT *, CASE WHEN {_bucket('user_id', 'movie_id')} < 80 THEN 'train' ELSE 'val' END AS split FROM r1),
train AS (SELECT user_id, movie_id, rating, timestamp FROM r1s WHERE split = 'train'),
val AS (SELECT user_id, movie_id, rating, timestamp FROM r1s WHERE split = 'val')"""

MODEL = ",\n".join([R1, cells_of("r1"), sims_of(), NB, SPLIT])


def _predict(pairs: str, name: str, k: int = K, weighted: bool = False) -> str:
    mean = "sum(t.rating * nb.similarity) / sum(nb.similarity)" if weighted else "avg(t.rating)"
    return f"""{name}_keys AS (SELECT DISTINCT user_id, movie_id FROM {pairs}),
{name}_agg AS (SELECT q.user_id, q.movie_id, {mean} AS p FROM {name}_keys q
     JOIN nb ON nb.user_id = q.user_id AND nb.rank <= {k}
     JOIN train t ON t.user_id = nb.neighbor_id AND t.movie_id = q.movie_id GROUP BY 1, 2),
{name} AS (SELECT s.*, CASE WHEN a.p IS NULL THEN 3.0 ELSE least(greatest(a.p, 0.5), 5.0) END AS prediction
     FROM {pairs} s LEFT JOIN {name}_agg a ON a.user_id = s.user_id AND a.movie_id = s.movie_id)"""


SCORED = MODEL + ",\n" + _predict("val", "scored")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- oracle statements ----------------------------------------------------------------------

def _rules_case(rules=REF_RULES) -> str:
    whens = " ".join(f"WHEN NOT {_in(c, lo, hi)} THEN '{c}'" for c, lo, hi in rules)
    return f"CASE {whens} END"


def _validation_report(rdc: str, source: str = "rdc") -> str:
    not_null = "user_id IS NOT NULL AND movie_id IS NOT NULL AND NOT coalesce(isnan(rating), true) AND timestamp IS NOT NULL"
    return _with(rdc, f"""agg AS (SELECT
   count_if(user_id IS NULL) + count_if(movie_id IS NULL) + count_if(rating IS NULL OR isnan(rating))
     + count_if(timestamp IS NULL) AS dtype_errors,
   count_if(NOT ({_all_in()})) AS range_violations,
   count_if(({_all_in()}) AND NOT ({not_null})) AS null_violations,
   count_if(({_all_in()}) AND ({not_null})) AS rows_retained,
   count_if(user_id IS NULL OR movie_id IS NULL OR timestamp IS NULL) AS int_fail FROM {source})""") + """
SELECT CAST(CASE WHEN int_fail = 0 THEN dtype_errors + range_violations + null_violations END AS BIGINT) AS total_errors,
       CAST(CASE WHEN int_fail = 0 THEN dtype_errors END AS BIGINT) AS dtype_errors,
       CAST(CASE WHEN int_fail = 0 THEN range_violations END AS BIGINT) AS range_violations,
       CAST(CASE WHEN int_fail = 0 THEN null_violations END AS BIGINT) AS null_violations,
       CAST(CASE WHEN int_fail = 0 THEN rows_retained END AS BIGINT) AS rows_retained,
       CASE WHEN int_fail > 0 THEN 'Datatype conversion failed' END AS error
FROM agg"""


def _recommend(requests_cte: str | None) -> str:
    users = ("users AS (SELECT r.user_id, r.n FROM rq r WHERE r.user_id IN (SELECT user_id FROM cells))"
             if requests_cte else f"users AS (SELECT DISTINCT user_id, {K} AS n FROM cells)")
    ctes = [MODEL] + ([requests_cte] if requests_cte else []) + [
        users,
        "catalog AS (SELECT DISTINCT movie_id FROM cells)",
        """cand AS (SELECT u.user_id, m.movie_id, u.n FROM users u CROSS JOIN catalog m
           WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.user_id = u.user_id AND c.movie_id = m.movie_id))""",
        f"""votes AS (SELECT c.user_id, c.movie_id, avg(t.rating) AS p FROM cand c
           JOIN nb ON nb.user_id = c.user_id AND nb.rank <= {K}
           JOIN train t ON t.user_id = nb.neighbor_id AND t.movie_id = c.movie_id GROUP BY 1, 2)""",
        """pred AS (SELECT c.user_id, c.movie_id, c.n, CASE WHEN v.p IS NULL THEN 3.0 ELSE least(greatest(v.p, 0.5), 5.0) END AS predicted_rating
           FROM cand c LEFT JOIN votes v ON v.user_id = c.user_id AND v.movie_id = c.movie_id)""",
        """ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY predicted_rating DESC, movie_id ASC) AS rank
           FROM pred)"""]
    return _with(*ctes) + "SELECT user_id, movie_id, predicted_rating, CAST(rank AS BIGINT) AS rank FROM ranked WHERE rank <= n"


def _user_knn(k_list) -> str:
    ks = ", ".join(f"({i}, {k})" for i, k in enumerate(k_list))
    return _with(
        R1, cells_of("r1"),
        f"us AS (SELECT user_id, CASE WHEN {_bucket('user_id')} < 80 THEN 'train' ELSE 'val' END AS split "
        "FROM (SELECT DISTINCT user_id FROM cells))",
        "tru AS (SELECT user_id FROM us WHERE split = 'train')",
        "teu AS (SELECT user_id FROM us WHERE split = 'val')",
        "qc AS (SELECT user_id, movie_id, CAST(round(rating * 1000000) AS BIGINT) AS q FROM cells)",
        "n2 AS (SELECT user_id, CAST(sum(q * q) AS DOUBLE) AS n2 FROM qc GROUP BY user_id)",
        """dp AS (SELECT a.user_id AS u, b.user_id AS v, CAST(sum(a.q * b.q) AS DOUBLE) AS dot
           FROM qc a JOIN qc b ON a.movie_id = b.movie_id
           WHERE a.user_id IN (SELECT user_id FROM teu) AND b.user_id IN (SELECT user_id FROM tru) GROUP BY 1, 2)""",
        """allp AS (SELECT t.user_id, r.user_id AS neighbor_id,
                  coalesce(dp.dot / (sqrt(x.n2) * sqrt(y.n2)), 0.0) AS similarity
           FROM teu t CROSS JOIN tru r LEFT JOIN dp ON dp.u = t.user_id AND dp.v = r.user_id
           LEFT JOIN n2 x ON x.user_id = t.user_id LEFT JOIN n2 y ON y.user_id = r.user_id)""",
        """rk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY similarity DESC, neighbor_id ASC) AS rank
           FROM allp)""",
        "y AS (SELECT user_id, avg(rating) AS target FROM r1 GROUP BY user_id)",
        f"ks AS (SELECT * FROM (VALUES {ks}) t(position, k))",
        "ntr AS (SELECT count(*) AS n FROM tru)",
        """pred AS (SELECT ks.position, ks.k, rk.user_id, avg(y.target) AS prediction
           FROM rk JOIN ks ON rk.rank <= least(ks.k, (SELECT n FROM ntr))
           JOIN y ON y.user_id = rk.neighbor_id GROUP BY 1, 2, 3)""",
        "pt AS (SELECT p.*, y.target FROM pred p JOIN y ON y.user_id = p.user_id)")


SWEEP = _user_knn(K_LIST) + """, sw AS (SELECT CAST(position AS BIGINT) AS position, CAST(k AS BIGINT) AS k,
       sqrt(avg((prediction - target) ^ 2)) AS rmse,
       avg(abs(prediction - target)) AS mae,
       avg(CASE WHEN prediction >= 0.5 THEN 1.0 ELSE 0.0 END) AS coverage,
       'completed' AS status FROM pt GROUP BY position, k)
"""

SPLIT_EXACT = SPLIT[SPLIT.index("train AS"):]
SPLIT_EXACT = f"""r1h AS (SELECT *, row_number() OVER (ORDER BY {_hash32('user_id', 'movie_id')}, user_id, movie_id) - 1 AS pos,
        count(*) OVER () AS n FROM r1),
r1s AS (SELECT user_id, movie_id, rating, timestamp, CASE WHEN pos < floor(n * 0.8) THEN 'train' ELSE 'val' END AS split FROM r1h),
""" + SPLIT_EXACT


def _tune(split: str) -> str:
    ks = ", ".join(f"({i}, {k})" for i, k in enumerate(K_LIST))
    return _with(R1, cells_of("r1"), sims_of(), NB, split, f"ks AS (SELECT * FROM (VALUES {ks}) t(position, k))",
                 """tk_votes AS (SELECT ks.position, ks.k, v.user_id, v.movie_id, avg(t.rating) AS p
                FROM (SELECT DISTINCT user_id, movie_id FROM val) v CROSS JOIN ks
                JOIN nb ON nb.user_id = v.user_id AND nb.rank <= ks.k
                JOIN train t ON t.user_id = nb.neighbor_id AND t.movie_id = v.movie_id GROUP BY 1, 2, 3, 4)""",
                 """tk_scored AS (SELECT ks.position, ks.k, v.rating,
                  CASE WHEN tv.p IS NULL THEN 3.0 ELSE least(greatest(tv.p, 0.5), 5.0) END AS prediction
                FROM val v CROSS JOIN ks LEFT JOIN tk_votes tv
                  ON tv.position = ks.position AND tv.user_id = v.user_id AND tv.movie_id = v.movie_id)""",
                 """tk AS (SELECT CAST(position AS BIGINT) AS position, CAST(k AS BIGINT) AS k,
                  sqrt(avg((prediction - rating) ^ 2)) AS rmse,
                  avg(abs(prediction - rating)) AS mae FROM tk_scored GROUP BY position, k)""")


TUNE = _tune(SPLIT)

_ERR = "abs(rating - prediction)"


def _zero_fill() -> str:
    return _with(
        R1, cells_of("r1"), REQ,
        "users AS (SELECT DISTINCT user_id FROM cells)",
        "kk AS (SELECT least(5, count(*)) AS k FROM users)",
        "known AS (SELECT * FROM req WHERE user_id IN (SELECT user_id FROM cells) AND movie_id IN (SELECT movie_id FROM cells))",
        sims_of(),
        """allp AS (SELECT a.user_id, b.user_id AS neighbor_id,
                  CASE WHEN a.user_id = b.user_id THEN 2.0 ELSE coalesce(s.similarity, 0.0) END AS similarity
           FROM (SELECT DISTINCT user_id FROM known) a CROSS JOIN users b
           LEFT JOIN sim s ON s.user_id = a.user_id AND s.neighbor_id = b.user_id)""",
        """rk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY similarity DESC, neighbor_id ASC) AS rank
           FROM allp)""",
        """agg AS (SELECT q.user_id, q.movie_id, sum(coalesce(c.rating, 0.0)) / (SELECT k FROM kk) AS predicted_rating
           FROM (SELECT DISTINCT user_id, movie_id FROM known) q
           JOIN rk ON rk.user_id = q.user_id AND rk.rank <= (SELECT k FROM kk)
           LEFT JOIN cells c ON c.user_id = rk.neighbor_id AND c.movie_id = q.movie_id GROUP BY 1, 2)""") + \
        """SELECT k.event_id, k.user_id, k.movie_id, round(a.predicted_rating, 6) AS predicted_rating
FROM known k JOIN agg a ON a.user_id = k.user_id AND a.movie_id = k.movie_id"""


def _quantiles_sql(src: str, col: str, probs: dict) -> str:
    return ", ".join(f"round(quantile_cont({col}, {p}), 6) AS {name}" for name, p in probs.items())


PCTS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}
BINS = ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5), (1.5, 2.0), (2.0, 5.0))


def _coverage(t: float) -> str:
    return (f"cov AS (SELECT CAST(count_if(best >= {t}) AS BIGINT) AS n_recommended, CAST(count(*) AS BIGINT) AS n_total "
            f"FROM (SELECT movie_id, max(prediction) AS best FROM scored GROUP BY movie_id))")


def _cov_select(t: float, verdict: bool = False) -> str:
    v = (", CASE WHEN n_recommended / n_total > 0.8 THEN 'good' WHEN n_recommended / n_total > 0.5 "
         "THEN 'moderate' ELSE 'low' END AS verdict") if verdict else ""
    return (f"SELECT round(n_recommended / n_total, 6) AS coverage_ratio, n_recommended, n_total, "
            f"CAST({t} AS DOUBLE) AS recommendation_threshold{v} FROM cov")


def _per_stats(key: str) -> str:
    return _with(R1, f"per AS (SELECT {key}, count(*) AS n FROM r1 GROUP BY {key})") + \
        ("SELECT round(avg(n), 6) AS mean, CAST(min(n) AS BIGINT) AS min, CAST(max(n) AS BIGINT) AS max, "
         "round(quantile_cont(n, 0.5), 6) AS median FROM per")


BASE = """base AS (SELECT avg(rating) AS m, quantile_cont(rating, 0.5) AS med FROM scored),
bl AS (SELECT round(b.m, 6) AS mean_value, round(sqrt(avg((s.rating - b.m) ^ 2)), 6) AS mean_rmse,
              round(b.med, 6) AS median_value, round(sqrt(avg((s.rating - b.med) ^ 2)), 6) AS median_rmse,
              CAST(3.0 AS DOUBLE) AS neutral_value, round(sqrt(avg((s.rating - 3.0) ^ 2)), 6) AS neutral_rmse,
              round(least(sqrt(avg((s.rating - b.m) ^ 2)), sqrt(avg((s.rating - b.med) ^ 2)),
                          sqrt(avg((s.rating - 3.0) ^ 2))), 6) AS best_baseline_rmse
       FROM scored s CROSS JOIN base b GROUP BY b.m, b.med)"""


RAW_BASE = BASE.replace("round(", "(").replace(", 6)", ")")


def _flat_report() -> str:
    """E11 as (section, metric, value), each number by its own plain definition."""
    one = {"test_set.n_samples": "count(*)", "rating_prediction.rmse": f"sqrt(avg(({_ERR}) ^ 2))", "rating_prediction.mae": f"avg({_ERR})",
           "rating_prediction.n_samples": "count(*)", "rating_prediction.median_error": f"quantile_cont({_ERR}, 0.5)"}
    for section in ("rating_prediction", "error_distribution"):
        one |= {f"{section}.mean_error": f"avg({_ERR})", f"{section}.std_error": f"stddev_pop({_ERR})",
                f"{section}.min_error": f"min({_ERR})", f"{section}.max_error": f"max({_ERR})"}
    one |= {f"percentiles.{n}": f"quantile_cont({_ERR}, {p})" for n, p in PCTS.items()}
    one |= {f"error_bins.error_{lo:.1f}_{hi:.1f}": f"count_if({_ERR} >= {lo} AND {_ERR} < {hi})" for lo, hi in BINS}
    parts = [(k, v, "scored") for k, v in one.items()]
    parts += [(f"coverage.{c}", c, "cov") for c in ("n_recommended", "n_total")]
    parts += [("coverage.coverage_ratio", "n_recommended / n_total", "cov"), ("coverage.recommendation_threshold", "0.5", "cov")]
    parts += [(f"sparsity.{c}", c, "sps") for c in ("n_users", "n_movies", "n_ratings")]
    parts += [("sparsity.max_possible", "n_users * n_movies", "sps"), ("sparsity.density", "n_ratings / (n_users * n_movies)", "sps"),
              ("sparsity.sparsity", "1 - n_ratings / (n_users * n_movies)", "sps")]
    parts += [(f"baselines.{c}", c, "bl") for c in ("mean_value", "mean_rmse", "median_value", "median_rmse", "neutral_value", "neutral_rmse", "best_baseline_rmse")]
    parts += [("baselines.beats_baseline", f"CAST((SELECT sqrt(avg(({_ERR}) ^ 2)) FROM scored) < best_baseline_rmse AS INTEGER)", "bl")]
    rows = [f"SELECT '{k.split('.', 1)[0]}' AS section, '{k.split('.', 1)[1]}' AS metric, round(CAST({v} AS DOUBLE), 6) AS value FROM {t}"
            for k, v, t in parts]
    rows += [f"SELECT 'engagement_' || segment, '{m}', round(CAST({v} AS DOUBLE), 6) FROM seg"
             for m, v in (("n_samples", "n_samples"), ("mae", "mae"), ("mean_engagement", "mean_engagement"))]
    return _with(SCORED, _coverage(0.5), RAW_BASE, "sps AS (SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT movie_id) AS n_movies, count(*) AS n_ratings FROM cells)",
                 f"pu AS (SELECT user_id, count(*) AS n, sum({_ERR}) AS se FROM scored GROUP BY user_id)",
                 """seg AS (SELECT CASE WHEN n <= 5 THEN 'low' WHEN n <= 20 THEN 'medium' ELSE 'high' END AS segment,
       sum(n) AS n_samples, sum(se) / sum(n) AS mae, sum(n * n) / sum(n) AS mean_engagement FROM pu GROUP BY 1)""") + "\nUNION ALL ".join(rows)


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o["coerce_types"] = _with(RDC) + "SELECT event_id, user_id, movie_id, rating, timestamp FROM rdc"
    o["coerce_error_counts"] = _with(RDC) + """SELECT CAST(count_if(user_id IS NULL) AS BIGINT) AS user_id_errors,
  CAST(count_if(movie_id IS NULL) AS BIGINT) AS movie_id_errors,
  CAST(count_if(rating IS NULL OR isnan(rating)) AS BIGINT) AS rating_errors,
  CAST(count_if(timestamp IS NULL) AS BIGINT) AS timestamp_errors,
  CAST(count_if(user_id IS NULL) + count_if(movie_id IS NULL) + count_if(rating IS NULL OR isnan(rating))
       + count_if(timestamp IS NULL) AS BIGINT) AS dtype_errors,
  count_if(user_id IS NULL OR movie_id IS NULL OR timestamp IS NULL) > 0 AS aborted FROM rdc"""
    o["range_filter"] = _with(R1_RAW) + f"SELECT * FROM r1_raw WHERE {_all_in()}"
    o["range_violations"] = _with(R1_RAW, f"ff AS (SELECT {_rules_case()} AS f FROM r1_raw)",
                                  "rules AS (SELECT * FROM (VALUES (1, 'user_id'), (2, 'movie_id'), (3, 'rating'), "
                                  "(4, 'timestamp')) t(position, column_name))") + \
        """SELECT CAST(r.position AS BIGINT) AS position, r.column_name,
       CAST((SELECT count(*) FROM ff WHERE ff.f = r.column_name) AS BIGINT) AS invalid FROM rules r"""
    o["drop_nulls"] = _with(RDC) + ("SELECT user_id, movie_id, rating, timestamp, event_id FROM rdc WHERE user_id IS NOT NULL "
                                    "AND movie_id IS NOT NULL AND NOT coalesce(isnan(rating), true) AND timestamp IS NOT NULL")
    o["validation_report"] = _validation_report(RDC)
    o["validation_report_abort"] = _validation_report(RDXC)
    o["rating_filter_1_5"] = _with(R1_RAW) + "SELECT * FROM r1_raw WHERE rating BETWEEN 1.0 AND 5.0"
    o["soft_range_count"] = _with(R1_RAW) + ("SELECT CAST(count_if(NOT isnan(rating) AND (rating < 0.5 OR rating > 5.5)) AS BIGINT) AS n_outside, "
                                             "CAST(count(*) AS BIGINT) AS n_rows FROM r1_raw")
    nc = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count_if({cond}) AS BIGINT) AS null_count, count_if({cond}) > 0 AS has_nulls FROM rdc"
        for c, cond in (("user_id", "user_id IS NULL"), ("movie_id", "movie_id IS NULL"),
                        ("rating", "rating IS NULL OR isnan(rating)"), ("timestamp", "timestamp IS NULL")))
    o["null_columns"] = _with(RDC) + nc
    o["dedup_latest"] = _with(R1_RAW, """d AS (SELECT *, row_number() OVER (PARTITION BY user_id, movie_id
        ORDER BY timestamp DESC, event_id DESC) AS rn FROM r1_raw)""") + \
        "SELECT user_id, movie_id, rating, timestamp, event_id FROM d WHERE rn = 1"
    o["dedup_first"] = _with(R1_RAW, """d AS (SELECT *, row_number() OVER (PARTITION BY user_id, movie_id
        ORDER BY event_id ASC) AS rn FROM r1_raw)""") + \
        "SELECT user_id, movie_id, rating, timestamp, event_id FROM d WHERE rn = 1"
    o["dataset_summary"] = _with(R1) + """SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
  CAST(count(DISTINCT movie_id) AS BIGINT) AS n_movies,
  round((1.0 - count(*) / (count(DISTINCT user_id) * count(DISTINCT movie_id))) * 100, 6) AS sparsity_pct FROM r1"""
    o["expectations"] = _with(R1, "a AS (SELECT count(*) AS raw_rows FROM r1_raw)",
                              """b AS (SELECT count(*) AS clean_rows, count(DISTINCT user_id) AS u,
                                   count(DISTINCT movie_id) AS m FROM r1)""") + """
SELECT 'raw_rows' AS metric, CAST(raw_rows AS DOUBLE) AS actual, CAST(2000 AS DOUBLE) AS expected, raw_rows >= 2000 AS passed FROM a
UNION ALL SELECT 'min_clean_rows', CAST(clean_rows AS DOUBLE), 1800.0, clean_rows >= 1800 FROM b
UNION ALL SELECT 'target_sparsity', round(1.0 - clean_rows / (u * m), 6), 0.9,
                 1.0 - clean_rows / (u * m) >= 0.9 FROM b"""
    latest = """d AS (SELECT *, row_number() OVER (PARTITION BY user_id, movie_id
        ORDER BY timestamp DESC, event_id DESC) AS rn FROM rdc)"""
    strict = f"SELECT user_id, movie_id, rating, timestamp FROM d WHERE rn = 1 AND {_all_in()} AND NOT coalesce(isnan(rating), true)"
    o["ingest_strict"] = _with(RDC, latest) + strict
    o["ingest_strict_text"] = _with(RTC, latest) + strict
    o["coerce_types_text"] = _with(RTC) + "SELECT event_id, user_id, movie_id, rating, timestamp FROM rdc"
    o["ingest_simple"] = _with(R1_RAW, """d AS (SELECT *, row_number() OVER (PARTITION BY user_id, movie_id
        ORDER BY event_id ASC) AS rn FROM r1_raw WHERE rating BETWEEN 1.0 AND 5.0)""") + \
        "SELECT user_id, movie_id, rating, timestamp FROM d WHERE rn = 1"
    o["valid_requests"] = _with(REQ) + "SELECT event_id, user_id, movie_id FROM req WHERE user_id > 0 AND movie_id > 0"

    # features
    o["rating_cells"] = _with(R1_RAW, f"v AS (SELECT * FROM r1_raw WHERE {_all_in()})", cells_of("v")) + \
        "SELECT user_id, movie_id, rating FROM cells"
    columns = ", ".join(f'coalesce(max(CASE WHEN movie_id = {m} THEN rating END), 0.0) AS "{m}"' for m in range(1, 101))
    o["rating_matrix"] = _with(R1, cells_of("r1")) + f"SELECT user_id, {columns} FROM cells GROUP BY user_id"
    o["user_index"] = _with(R1, cells_of("r1")) + \
        "SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS user_idx FROM (SELECT DISTINCT user_id FROM cells)"
    o["movie_index"] = _with(R1, cells_of("r1")) + \
        "SELECT movie_id, CAST(row_number() OVER (ORDER BY movie_id) - 1 AS BIGINT) AS movie_idx FROM (SELECT DISTINCT movie_id FROM cells)"
    o["matrix_density"] = _with(R1, cells_of("r1"), """s AS (SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
        CAST(count(DISTINCT movie_id) AS BIGINT) AS n_movies, CAST(count(*) AS BIGINT) AS n_ratings FROM cells)""") + \
        """SELECT n_users, n_movies, n_ratings, n_users * n_movies AS max_possible,
       round(n_ratings / (n_users * n_movies), 6) AS density, round(1 - n_ratings / (n_users * n_movies), 6) AS sparsity FROM s"""
    o["user_similarity"] = _with(R2, cells_of("r2"), sims_of()) + "SELECT user_id, neighbor_id, similarity FROM sim"
    o["user_similarity_full"] = _with(R1, cells_of("r1"), sims_of()) + \
        "SELECT user_id, neighbor_id, similarity FROM sim UNION ALL SELECT DISTINCT user_id, user_id, 1.0 FROM cells"
    o["similar_users"] = _with(R2, cells_of("r2"), sims_of(), NB) + \
        "SELECT user_id, neighbor_id, similarity, CAST(rank AS BIGINT) AS rank FROM nb WHERE rank <= 5"
    o["similar_users_requested"] = _with(R2, cells_of("r2"), sims_of(), NB) + \
        """SELECT user_id, neighbor_id, similarity, CAST(rank AS BIGINT) AS rank FROM nb
WHERE rank <= 5 AND user_id IN (SELECT DISTINCT user_id FROM events)"""
    o["user_vector"] = _with(R1, cells_of("r1"), "m AS (SELECT DISTINCT movie_id FROM cells)",
                             "u AS (SELECT DISTINCT user_id FROM cells)") + \
        """SELECT u.user_id, list(coalesce(c.rating, 0.0) ORDER BY m.movie_id) AS ratings
FROM u CROSS JOIN m LEFT JOIN cells c ON c.user_id = u.user_id AND c.movie_id = m.movie_id GROUP BY u.user_id"""
    o["rating_stats"] = _with(R1, cells_of("r1")) + """SELECT round(avg(rating), 6) AS mean_rating,
  round(stddev_pop(rating), 6) AS std_rating, min(rating) AS min_rating, max(rating) AS max_rating,
  CAST(count(rating) AS BIGINT) AS n_rated FROM cells"""
    o["user_profile"] = _with(R1, cells_of("r1")) + \
        "SELECT user_id, CAST(count(*) AS BIGINT) AS n_rated, round(avg(rating), 6) AS avg_rating FROM cells GROUP BY user_id"

    # model
    o["knn_predict"] = _with(SCORED) + "SELECT user_id, movie_id, rating, prediction FROM scored"
    o["knn_predict_weighted"] = _with(MODEL, _predict("val", "scored", weighted=True)) + \
        "SELECT user_id, movie_id, rating, round(prediction, 6) AS prediction FROM scored"
    o["predict_batch"] = _with(MODEL, REQ, _predict("req", "pb")) + \
        "SELECT event_id, user_id, movie_id, prediction FROM pb"
    o["recommend_user"] = _recommend("""rq AS (SELECT user_id, CAST(least(greatest(floor(count(*) / 10), 1), 50) AS INTEGER) AS n
        FROM events GROUP BY user_id)""")
    o["recommend_all"] = _recommend(None)
    o["predict_batch_zero_fill"] = _zero_fill()
    o["split_rows"] = _with(R1, SPLIT) + "SELECT user_id, movie_id, rating, timestamp, split FROM r1s"
    o["split_rows_exact"] = _with(R1, f"""h AS (SELECT *, row_number() OVER (ORDER BY {_hash32('user_id', 'movie_id')}, user_id, movie_id) - 1 AS pos,
        count(*) OVER () AS n FROM r1)""") + \
        "SELECT user_id, movie_id, rating, timestamp, CASE WHEN pos < floor(n * 0.8) THEN 'train' ELSE 'val' END AS split FROM h"
    o["split_users"] = _with(R1, cells_of("r1")) + \
        f"SELECT user_id, CASE WHEN {_bucket('user_id')} < 80 THEN 'train' ELSE 'val' END AS split FROM (SELECT DISTINCT user_id FROM cells)"
    o["user_mean_rating"] = _with(R1) + "SELECT user_id, round(avg(rating), 6) AS target FROM r1 GROUP BY user_id"
    o["user_knn_predict"] = _user_knn((K,)) + \
        "SELECT user_id, round(prediction, 6) AS prediction, round(target, 6) AS target FROM pt"
    o["tune_k"] = TUNE + "SELECT position, k, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM tk"
    o["tune_best_k"] = TUNE + "SELECT k, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM (SELECT * FROM tk ORDER BY rmse, position LIMIT 1)"
    o["sweep_k"] = SWEEP + "SELECT position, k, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(coverage, 6) AS coverage, status FROM sw"
    o["best_run"] = SWEEP + "SELECT k, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(coverage, 6) AS coverage, status FROM (SELECT * FROM sw ORDER BY rmse, position LIMIT 1)"
    o["run_leaderboard"] = SWEEP + """SELECT 'knn_sweep_k' || CAST(k AS VARCHAR) AS run_id, k AS k_value, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(coverage, 6) AS coverage,
       upper(status) AS status, CAST(row_number() OVER (ORDER BY sw.rmse ASC NULLS LAST, k ASC) AS BIGINT) AS leaderboard_rank FROM sw"""
    o["train_report"] = _tune(SPLIT_EXACT) + """, best AS (SELECT * FROM tk ORDER BY rmse, position LIMIT 1)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM train) AS n_train, (SELECT CAST(count(*) AS BIGINT) FROM val) AS n_val,
       k, false AS use_similarity_weights, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM best"""
    o["actual_vs_predicted"] = _with(MODEL, _predict("r1", "ap")) + \
        "SELECT user_id, movie_id, rating AS actual, prediction AS predicted, abs(rating - prediction) AS abs_error FROM ap"
    o["sample_error_metrics"] = _with(
        MODEL, f"smp AS (SELECT user_id, movie_id, rating FROM r1 ORDER BY {_hash32('user_id', 'movie_id')}, user_id, movie_id LIMIT 10)",
        _predict("smp", "sp")) + """SELECT CAST(count(*) AS BIGINT) AS n_samples, round(avg(abs(prediction - rating)), 6) AS mae,
       round(sqrt(avg((prediction - rating) ^ 2)), 6) AS rmse FROM sp"""

    # evaluation
    o["rating_metrics"] = _with(SCORED) + f"""SELECT round(sqrt(avg(({_ERR}) ^ 2)), 6) AS rmse, round(avg({_ERR}), 6) AS mae,
  round(avg({_ERR}), 6) AS mean_error, round(stddev_pop({_ERR}), 6) AS std_error, round(min({_ERR}), 6) AS min_error,
  round(max({_ERR}), 6) AS max_error, CAST(count(*) AS BIGINT) AS n_samples,
  round(quantile_cont({_ERR}, 0.5), 6) AS median_error FROM scored"""
    o["error_percentiles"] = _with(SCORED) + f"SELECT {_quantiles_sql('scored', _ERR, PCTS)} FROM scored"
    o["catalog_coverage"] = _with(SCORED, _coverage(0.5)) + _cov_select(0.5)
    o["catalog_coverage_35"] = _with(SCORED, _coverage(3.5)) + _cov_select(3.5)
    o["coverage_verdict"] = _with(SCORED, _coverage(3.5)) + _cov_select(3.5, verdict=True)
    o["sparsity"] = _with(R1, """s AS (SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
        CAST(count(DISTINCT movie_id) AS BIGINT) AS n_movies, CAST(count(*) AS BIGINT) AS n_ratings FROM r1)""") + \
        """SELECT n_users, n_movies, n_ratings, n_users * n_movies AS max_possible,
       round(n_ratings / (n_users * n_movies), 6) AS density, round(1 - n_ratings / (n_users * n_movies), 6) AS sparsity FROM s"""
    o["ratings_per_user_stats"] = _per_stats("user_id")
    o["ratings_per_movie_stats"] = _per_stats("movie_id")
    o["error_histogram"] = _with(SCORED) + " UNION ALL ".join(
        f"SELECT 'error_{lo:.1f}_{hi:.1f}' AS bin, CAST({lo} AS DOUBLE) AS lower, CAST({hi} AS DOUBLE) AS upper, "
        f"CAST(count_if({_ERR} >= {lo} AND {_ERR} < {hi}) AS BIGINT) AS count, "
        f"round(count_if({_ERR} >= {lo} AND {_ERR} < {hi}) * 100.0 / count(*), 6) AS percentage FROM scored"
        for lo, hi in BINS)
    o["baselines"] = _with(SCORED, BASE) + "SELECT * FROM bl"
    o["engagement_segments"] = _with(SCORED, f"pu AS (SELECT user_id, count(*) AS n, sum({_ERR}) AS se FROM scored GROUP BY user_id)") + \
        """SELECT CASE WHEN n <= 5 THEN 'low' WHEN n <= 20 THEN 'medium' ELSE 'high' END AS segment,
       CAST(sum(n) AS BIGINT) AS n_samples, round(sum(se) / sum(n), 6) AS mae, round(sum(n * n) / sum(n), 6) AS mean_engagement
FROM pu GROUP BY 1"""
    o["beats_baseline"] = _with(SCORED, RAW_BASE, f"m AS (SELECT sqrt(avg(({_ERR}) ^ 2)) AS rmse FROM scored)") + \
        """SELECT round(m.rmse, 6) AS model_rmse, round(bl.best_baseline_rmse, 6) AS best_baseline_rmse,
       m.rmse < bl.best_baseline_rmse AS beats_baseline FROM m CROSS JOIN bl"""
    o["evaluation_metrics"] = _flat_report()
    o["similarity_off_grid"] = _with(R1_RAW, f"v AS (SELECT * FROM r1_raw WHERE {_all_in()})", cells_of("v"), sims_of()) + \
        "SELECT user_id, neighbor_id, similarity FROM sim"
    o["recommend_rejected"] = _with(R1, cells_of("r1"), "rq AS (SELECT user_id, count(*) * 7 % 61 AS n FROM events GROUP BY user_id)",
                                    """why AS (SELECT *, CASE WHEN NOT coalesce(n BETWEEN 1 AND 50, false) THEN 'n outside 1..50'
        WHEN user_id NOT IN (SELECT user_id FROM cells) THEN 'unknown user' END AS reason FROM rq)""") + \
        "SELECT user_id, n, reason FROM why WHERE reason IS NOT NULL"
    clean = _with(R1) + "SELECT user_id, movie_id, rating, timestamp FROM r1"
    o["ratings_tsv_round_trip"] = o["ratings_csv_round_trip"] = clean
    o["feature_store_round_trip"] = _with(R1, cells_of("r1"), sims_of()) + "SELECT user_id, neighbor_id, similarity FROM sim"
    o["model_store_round_trip"] = o["knn_predict"]
    o["report_round_trip"] = f"SELECT * EXCLUDE (error) FROM ({o['validation_report']})"
    o["prepare_features_lookups"] = _with(R1, cells_of("r1"), sims_of(), NB) + \
        """SELECT user_id, neighbor_id, similarity, CAST(rank AS BIGINT) AS rank FROM nb WHERE rank <= 3
AND user_id IN (SELECT DISTINCT user_id FROM cells ORDER BY user_id LIMIT 3)"""
    deduped = RDC + ",\n" + latest + ",\ndd AS (SELECT user_id, movie_id, rating, timestamp FROM d WHERE rn = 1)"
    o["ingest_strict_written"] = o["ingest_strict"]
    o["ingest_strict_report"] = f"SELECT * EXCLUDE (error) FROM ({_validation_report(deduped, 'dd')})"
    bad = "event_id % 89 = 0 OR event_id % 83 = 0 OR event_id % 97 = 0 OR event_id % 101 = 0"
    o["quarantine_rows"] = _with(R1_RAW) + f"""SELECT user_id, movie_id, CASE WHEN event_id % 103 <> 0 THEN rating END AS rating, timestamp
FROM r1_raw WHERE NOT ({bad})"""
    o["quarantine_rejects"] = _with(R1_RAW, """t AS (SELECT event_id,
        CASE WHEN event_id % 101 = 0 THEN 'x' ELSE CAST(user_id AS VARCHAR) END || chr(9) || CAST(movie_id AS VARCHAR) || chr(9)
          || CASE WHEN event_id % 97 = 0 THEN 'n/a' WHEN event_id % 103 = 0 THEN '' ELSE CAST(rating AS VARCHAR) END AS three, timestamp FROM r1_raw)""") + \
        f"""SELECT CASE WHEN event_id % 89 = 0 THEN three WHEN event_id % 83 = 0 THEN three || chr(9) || CAST(timestamp AS VARCHAR) || chr(9) || '7'
            ELSE three || chr(9) || CAST(timestamp AS VARCHAR) END AS line,
       CASE WHEN event_id % 89 = 0 THEN '3 fields instead of 4' WHEN event_id % 83 = 0 THEN '5 fields instead of 4'
            WHEN event_id % 101 = 0 THEN 'user_id does not parse' ELSE 'rating does not parse' END AS reason
FROM t WHERE {bad}"""
    o["dedup_latest_merged"] = o["dedup_latest"]
    o["user_index_incremental"] = _with(R1_RAW, "f AS (SELECT user_id, min(event_id % 3) AS l FROM r1_raw GROUP BY user_id)") + \
        "SELECT user_id, CAST(row_number() OVER (ORDER BY l, user_id) - 1 AS BIGINT) AS user_idx FROM f"
    o["dataset_summary_merged"] = o["dataset_summary"]
    o["error_percentiles_merged"] = o["error_percentiles"]
    o["run_log"] = o["run_leaderboard"]
    o["run_comparison_round_trip"] = f"SELECT * EXCLUDE (leaderboard_rank) FROM ({o['run_leaderboard']})"
    o["model_metadata"] = f"WITH t AS ({o['train_report']})" + " UNION ALL ".join(
        f" SELECT '{name}' AS name, CAST({value} AS DOUBLE) AS value FROM t" for name, value in (
            ("k", "k"), ("use_similarity_weights", "CASE WHEN use_similarity_weights THEN 1 ELSE 0 END"), ("default_rating", "3.0"),
            ("n_train", "n_train"), ("n_val", "n_val"), ("train_share", "0.8"), ("rmse", "rmse"), ("mae", "mae")))
    some = "(SELECT count(*) > 0 FROM r1_raw)"
    o["structural_checks"] = _with(R1_RAW) + " UNION ALL ".join(
        f"SELECT '{name}' AS name, {exact} AS exact_columns, {needed} AS required_columns, {rows} AS non_empty" for name, exact, needed, rows in (
            ("raw", "false", "true", some), ("ratings", "true", "true", some), ("no_timestamp", "false", "false", some),
            ("none_over_five", "true", "true", "(SELECT count(*) > 0 FROM r1_raw WHERE rating > 100)")))
    o["similar_users_pruned"] = o["similar_users"]
    o["similar_users_candidates"] = _with(R2, cells_of("r2"), sims_of(), """heads AS (SELECT * FROM (
        SELECT movie_id, user_id AS v, q, n2, row_number() OVER (PARTITION BY movie_id ORDER BY q / sqrt(n2) DESC, user_id) AS rn
        FROM sim_q JOIN sim_n2 USING (user_id)) WHERE rn <= 4)""", """part AS (
        SELECT a.user_id, v, CAST(sum(a.q * h.q) AS DOUBLE) AS dot, max(n.n2) AS nu, max(h.n2) AS nv
        FROM sim_q a JOIN heads h ON a.movie_id = h.movie_id AND a.user_id <> h.v JOIN sim_n2 n ON n.user_id = a.user_id GROUP BY a.user_id, v)""",
                                          """floors AS (SELECT user_id, floor FROM (SELECT user_id, dot / (sqrt(nu) * sqrt(nv)) AS floor,
        row_number() OVER (PARTITION BY user_id ORDER BY dot / (sqrt(nu) * sqrt(nv)) DESC, v) AS rn FROM part) WHERE rn = 5)""",
                                          """passed AS (SELECT s.user_id, count(*) AS n FROM sim s LEFT JOIN floors f ON s.user_id = f.user_id
        WHERE similarity >= coalesce(floor, 0.0) GROUP BY s.user_id)""",
                                          "co AS (SELECT count(*) AS n FROM cells GROUP BY movie_id)") + """
SELECT (SELECT CAST(sum(n * (n - 1)) AS BIGINT) FROM co) AS co_ratings, CAST(sum(n) AS BIGINT) AS candidates,
       CAST(sum(least(n, 5)) AS BIGINT) AS neighbours FROM passed"""
    o["matrix_blocks"] = _with(R2, cells_of("r2")) + "SELECT user_id, movie_id, rating FROM cells"
    o["user_vector_lookup"] = f"SELECT * FROM ({o['user_vector']}) WHERE user_id = (SELECT min(user_id) FROM ({o['user_profile']}))"
    o["gen_ratings"] = _with(f"""u AS (SELECT event_id,
        {_unif(1)} AS u1, {_unif(2)} AS u2, {_unif(3)} AS u3, {_unif(4)} AS u4, {_unif(5)} AS u5 FROM events)""") + \
        """SELECT CAST(floor(u1 * 189) + 1 AS BIGINT) AS user_id, CAST(floor(u2 * 100) + 1 AS BIGINT) AS movie_id,
       round(least(greatest(sqrt(-2.0 * ln(u3)) * cos(2.0 * pi() * u4) * 1.0 + 3.5, 1.0), 5.0), 6) AS rating,
       CAST(floor(u5 * (1104537600 - 788918400)) + 788918400 AS BIGINT) AS timestamp FROM u"""
    return o


def _unif(stream: int, seed: int = 42) -> str:
    return (f"((('0x' || substr(md5(concat_ws(':', event_id, '{seed}', '{stream}')), 1, 13))::BIGINT "
            f"+ 0.5) / 4503599627370496.0)")
