"""Ratings schema, validation rules and fixed parameters."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnRule:
    name: str
    dtype: str          # "int64" or "float64"
    lo: float
    hi: float | None    # None: no upper bound
    nullable: bool = False

    @property
    def spark_type(self) -> T.DataType:
        return T.LongType() if self.dtype == "int64" else T.DoubleType()


# --- Fixed values: must equal the reference's rating rules -------------------
# user_id   int64    1          1000        not nullable
# movie_id  int64    1          1700        not nullable
# rating    float64  0.5        5.0         not nullable
# timestamp int64    700000000  2000000000  not nullable
# Expected metrics: raw_rows 2000, min_clean_rows 1800, target_sparsity 0.90
# Default prediction 3.0; predictions clipped to [0.5, 5.0]
# Simple ingest keeps ratings in [1.0, 5.0]; soft check warns outside [0.5, 5.5]
# Tuning K values 3, 5, 10, 15, 20; coverage threshold 0.5
# Coverage verdict: > 0.8 good, > 0.5 moderate, else low
# Engagement: <= 5 low, 6..20 medium, > 20 high
# Error bins: [0, 0.5) [0.5, 1) [1, 1.5) [1.5, 2) [2, 5)
RATING_RULES: tuple[ColumnRule, ...] = (
    ColumnRule("user_id", "int64", 1, 1000),
    ColumnRule("movie_id", "int64", 1, 1700),
    ColumnRule("rating", "float64", 0.5, 5.0),
    ColumnRule("timestamp", "int64", 700000000, 2000000000),
)
EXPECTED_METRICS = {"raw_rows": 2000, "min_clean_rows": 1800, "target_sparsity": 0.90}
DEFAULT_RATING = 3.0
RATING_CLIP = (0.5, 5.0)
SIMPLE_RANGE = (1.0, 5.0)
SOFT_RANGE = (0.5, 5.5)
K_VALUES = (3, 5, 10, 15, 20)
COVERAGE_THRESHOLD = 0.5
COVERAGE_GOOD, COVERAGE_MODERATE = 0.8, 0.5
ENGAGEMENT_LOW_MAX, ENGAGEMENT_MEDIUM_MAX = 5, 20
ERROR_BINS = ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5), (1.5, 2.0), (2.0, 5.0))
SPLIT_TRAIN_PCT = 80
SEED = 42
# ---------------------------------------------------------------------------

RATING_COLUMNS = tuple(r.name for r in RATING_RULES)

RATINGS_SCHEMA = T.StructType([
    T.StructField(r.name, r.spark_type, r.nullable) for r in RATING_RULES
])


def wide_id_rules(rules: tuple[ColumnRule, ...] = RATING_RULES) -> tuple[ColumnRule, ...]:
    """Same rules with the id maxima lifted (the reference maxima are sized
    for a 189-user sample and would drop real ids)."""
    return tuple(replace(r, hi=None) if r.name in ("user_id", "movie_id") else r
                 for r in rules)


def string_schema(columns=RATING_COLUMNS) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
