"""State that is kept per load and merged, so that old loads aren't read again:
dense id dictionaries (F3), distinct counts (V13, E5, F4) and quantiles (E2, E6).

Each state is a small table; a load makes its own and a merge is an aggregate
over both (or over those of all loads).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import dense_index, exact_quantiles, reliable_checkpoint

#: Bits of one bitmap of Spark's bitmap functions (fixed: 4,096 bytes each).
BITMAP_BITS = 32_768
#: Accuracy parameter of the quantile sketches: rank errors near 0.1 percent.
SKETCH_K = 2048
#: Rank error that a bracket allows for, as a share of the rows; and the values that
#: a bracket may hold when they are sorted together.
SLACK, BRACKET_VALUES = 0.005, 5_000_000


# --- F3: a dictionary whose indexes never change -------------------------------

def extend_dictionary(dictionary: DataFrame | None, ids: DataFrame, id_col: str, index_col: str = "idx") -> DataFrame:
    """``dictionary`` (``id_col``, ``index_col``) plus the ids of a load that it
    doesn't have, numbered in id order after its last index (from 0 without one).

    Old indexes never change and the result stays dense.  Nulls get no index.  New
    ids are sorted by the cluster, not in one task.
    """
    new = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    start = 0
    if dictionary is not None:
        new = new.join(dictionary.select(id_col), id_col, "left_anti")
        start = (dictionary.agg(F.max(index_col)).first()[0] + 1) if not dictionary.isEmpty() else 0
    added = dense_index(new, [id_col], index_col, start=start)[0].select(id_col, index_col)
    return reliable_checkpoint(added if dictionary is None else dictionary.select(id_col, index_col).unionByName(added))


# --- V13 / E5 / F4: exact distinct counts ---------------------------------------

def distinct_state(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, bucket, bitmap, n_rows): the distinct ids of each long column as
    bitmaps of BITMAP_BITS ids, and in bucket null the rows that were counted."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("id")) for c in columns])).alias("p")
    ids = df.select(pairs).select("p.*").where("id is not null")
    maps = ids.groupBy("column_name", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))
    rows = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("").alias("column_name"), F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("bitmap"), "n_rows")
    return maps.withColumn("n_rows", F.lit(0).cast("long")).unionByName(rows)


def merge_distinct(*states: DataFrame) -> DataFrame:
    """One state for the rows of several loads: bitmaps are united, counts added."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    return both.groupBy("column_name", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("n_rows").alias("n_rows")) \
        .withColumn("bitmap", F.when(F.col("bucket").isNotNull(), F.col("bitmap")))


def summary_of(state: DataFrame, user_col: str = "user_id", movie_col: str = "movie_id") -> DataFrame:
    """V13 from a state: n_rows, n_users, n_movies, sparsity_pct."""
    size = lambda c: F.coalesce(F.sum(F.when(F.col("column_name") == c, F.bitmap_count("bitmap"))), F.lit(0)).cast("bigint")
    s = state.agg(F.sum("n_rows").cast("bigint").alias("n_rows"), size(user_col).alias("n_users"), size(movie_col).alias("n_movies"))
    return s.withColumn("sparsity_pct", (F.lit(1.0) - F.col("n_rows") / (F.col("n_users") * F.col("n_movies"))) * 100)


# --- E2 / E6: quantiles -----------------------------------------------------------

def quantile_state(df: DataFrame, value_col: str) -> DataFrame:
    """One row (sketch, low, high, n) about the values that aren't null."""
    v = F.col(value_col).cast("double")
    return df.where(v.isNotNull()).agg(F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias("sketch"), F.min(v).alias("low"),
                                       F.max(v).alias("high"), F.count(v).alias("n"))


def merge_quantiles(*states: DataFrame) -> DataFrame:
    """One state for the values of several loads."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    return both.where("n > 0").agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.min("low").alias("low"),
                                   F.max("high").alias("high"), F.sum("n").alias("n"))


def quantiles_of(state: DataFrame, df: DataFrame, value_col: str, probs: dict[str, float], slack: float = SLACK) -> DataFrame:
    """One row with the exact quantile (linear interpolation) for each ``name -> p`` of
    the rows ``df`` that ``state`` is about.

    The sketch gives a bracket around each rank; one pass counts the values between
    the brackets and sorts the distinct ones inside.  Should a bracket miss its
    rank (the sketch's error is a matter of chance), the answer comes from
    ``exact_quantiles`` instead.
    """
    spark = df.sparkSession
    n = (state.first() or {"n": 0})["n"] or 0
    schema = ", ".join(f"`{k}` double" for k in probs)
    if not n:
        return spark.createDataFrame([tuple(None for _ in probs)], schema)
    at = {name: p * (n - 1) for name, p in probs.items()}
    share = lambda x: min(1.0, max(0.0, x))
    ends = [(share(x / n - slack), share((x + 2) / n + slack)) for x in at.values()]
    ask = [F.kll_sketch_get_quantile_double("sketch", F.lit(e)) for pair in ends for e in pair]
    found = state.select("low", "high", *[c.alias(f"q{i}") for i, c in enumerate(ask)]).first()
    brackets = []
    for i, (a, b) in enumerate(ends):
        low, high = found["low"] if a <= 0 else found[f"q{2 * i}"], found["high"] if b >= 1 else found[f"q{2 * i + 1}"]
        brackets.append((low, high))
    merged: list[list[float]] = []
    for low, high in sorted(brackets):                        # overlapping brackets become one
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    v = F.col("_v")
    # Place 2 i + 1: inside bracket i; 2 i: between it and the one before.
    place = F.lit(2 * len(merged))
    for i, (low, high) in reversed(list(enumerate(merged))):
        place = F.when(v < low, 2 * i).when(v <= high, 2 * i + 1).otherwise(place)
    inside = F.col("_p") % 2 == 1
    counted = (df.select(F.col(value_col).cast("double").alias("_v")).where("_v is not null").withColumn("_p", place)
               .groupBy("_p", F.when(inside, v).alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    counted = reliable_checkpoint(counted)
    sizes = {r["_p"]: (r["n"], r["d"]) for r in counted.groupBy("_p").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("d")).collect()}   # a few rows
    starts, total = {}, 0
    for p in range(2 * len(merged) + 1):
        starts[p] = total
        total += sizes.get(p, (0, 0))[0]
    ranks = sorted({f(x) for x in at.values() for f in (math.floor, math.ceil)})
    of = {r: next((p for p in starts if starts[p] <= r < starts[p] + sizes.get(p, (0, 0))[0]), None) for r in ranks}
    if total != n or any(p is None or p % 2 == 0 for p in of.values()) or any(sizes[p][1] > BRACKET_VALUES for p in set(of.values())):
        return exact_quantiles(df, value_col, probs)
    run = Window.partitionBy("_p").orderBy("_v")
    upto = counted.where(inside).withColumn("_end", F.sum("_n").over(run))
    first = F.create_map(*[F.lit(x) for p in set(of.values()) for x in (p, starts[p])])
    wanted = upto.withColumn("_end", F.col("_end") + F.element_at(first, F.col("_p")))
    hits = wanted.withColumn("_r", F.explode(F.array(*[F.lit(r).cast("long") for r in ranks]))).where(
        (F.col("_r") < F.col("_end")) & (F.col("_r") >= F.col("_end") - F.col("_n")))
    values = {r["_r"]: r["_v"] for r in hits.select("_r", "_v").collect()}        # one row a rank
    row = tuple(values[math.floor(x)] + (values[math.ceil(x)] - values[math.floor(x)]) * (x - math.floor(x)) for x in at.values())
    return spark.createDataFrame([row], schema)
