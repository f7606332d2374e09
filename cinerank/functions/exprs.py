"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal numbers the way pandas.to_numeric accepts them.  Spark's own
# cast also takes suffixes such as '4f' or '1.0d'; those must count as errors.
NUMERIC_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; null stays null (``greatest``/``least`` skip nulls,
    which would turn a missing prediction into ``lo``)."""
    c = col_(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def epoch_seconds(ts: str) -> Column:
    """Whole seconds since 1970 for a TIMESTAMP_NTZ column (time-zone free)."""
    return F.expr(f"timestampdiff(SECOND, {EPOCH_NTZ}, `{ts}`)")


def to_double(c) -> Column:
    """Text or number -> double; anything pandas would not parse -> null."""
    s = F.trim(col_(c).cast("string"))
    return F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))


def to_long_truncating(c) -> Column:
    """Number or text -> whole number, truncated toward zero; unparsable -> null
    (the caller decides whether that aborts).  Whole and decimal forms are read
    digit by digit, so ids above 2^53 stay what they are; only exponent forms go
    through a double."""
    s = F.trim(col_(c).cast("string"))
    whole = F.regexp_replace(s, r"\..*$", "")
    return (F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("bigint"))
            .when(s.rlike(r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+)$"),
                  F.when(whole.isin("", "+", "-"), F.lit(0)).otherwise(whole.try_cast("bigint")))
            .otherwise(to_double(c).try_cast("bigint")))


def is_missing(c) -> Column:
    """pandas ``isnull()``: null, or NaN for doubles."""
    c = col_(c)
    return c.isNull() | F.isnan(c)


def split_bucket(*cols, seed: int) -> Column:
    """Portable 0..99 bucket: first 32 bits of md5('c1:c2:...:seed') mod 100.

    md5 is used because DuckDB computes the same digest, so an oracle can
    reproduce every split exactly (xxhash64 has no twin there).
    """
    key = F.concat_ws(":", *[col_(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substr(F.md5(key), F.lit(1), F.lit(8)), 16, 10).cast("bigint") % 100


def round6(c) -> Column:
    return F.round(col_(c), 6)


def with_scalars(df, one_row):
    """Attach the columns of a one-row DataFrame (an aggregate) to every row
    of ``df`` as an uncorrelated scalar subquery: Spark runs the aggregate
    once and inlines the value — no join, nothing broadcast but one row."""
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("_s")).scalar()
    return df.select("*", *[packed.getField(c).alias(c) for c in cols])
