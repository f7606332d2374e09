"""Distributed global ordering helpers: dense indexes and exact quantiles.

Both avoid the two single-task shapes that break at scale: an un-partitioned
``row_number() OVER (ORDER BY ...)`` window (the whole table in one task) and
the exact ``percentile`` aggregate (every distinct value held by the one final
task).  An index range-partitions and sorts the rows and adds each partition's
offset; a quantile narrows a bracket around its rank by counting.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PART_BITS = 33
#: Values that a quantile's bracket may hold when they are sorted together.
BRACKET_ROWS = 100_000
#: Rank accuracy of the approximate percentiles that narrow a bracket.
ACCURACY = 10_000
#: Largest table that ``maybe_broadcast`` broadcasts.
BROADCAST_BYTES = 64 << 20

_STAGES: dict[str, list[str]] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet stage table in the shared checkpoint
    folder and return a DataFrame reading it back (lineage cut).

    One job writes it (``Dataset.checkpoint`` would compute the plan twice:
    once to count, once to write); later stages re-read columnar files with
    pruning, and see exactly the same rows even if executors are lost and
    tasks re-run (ids derived from partition positions stay fixed).  The job's
    shuffle files are deleted at its end instead of some time after.
    """
    spark, path = df.sparkSession, stage_folder(df.sparkSession)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.parquet(path)


def stage_folder(spark) -> str:
    """A new folder below the shared checkpoint folder, for a stage table."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cinerank-stage-{uuid.uuid4().hex}"
    _STAGES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage_tables(spark) -> list[str]:
    """Folders of this application's stage tables that are still there."""
    return list(_STAGES.get(spark.sparkContext.applicationId, ()))


def release_stages(spark, keep: tuple[str, ...] = ()) -> None:
    """Delete this application's stage tables, but those of ``keep``.  Call it when the
    results made so far have been written or read: a DataFrame that still reads a
    stage table can't be evaluated afterwards."""
    sc = spark.sparkContext
    paths = _STAGES.pop(sc.applicationId, [])
    _STAGES[sc.applicationId] = [p for p in paths if p in keep]
    for path in (p for p in paths if p not in keep):
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def dense_index(df: DataFrame, order_cols: list, index_col: str = "idx",
                start: int = 0, num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """(``df`` + ``index_col``, row count): ``index_col`` is each row's position
    in the global order (0-based plus ``start``), computed without moving
    the rows into one task — the same scheme as ``RDD.zipWithIndex``.

    The rows are range-partitioned and sorted by the cluster, numbered with
    ``monotonically_increasing_id`` (partition index in the upper 31 bits),
    and stored as a stage table so the numbers never change.  A table of
    offsets, one row a partition, is joined to them.  ``order_cols`` should be a
    total order for positions to be reproducible.
    """
    # Without an explicit count AQE sizes the range partitions from the data
    # (positions are taken after that, from the written stage table).
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions \
        else df.repartitionByRange(*order_cols)
    ranged = reliable_checkpoint(ranged.sortWithinPartitions(*order_cols)
                                 .withColumn("_mid", F.monotonically_increasing_id())
                                 .withColumn("_part", F.shiftright("_mid", _PART_BITS)))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    # One row a partition (16 bytes each): small enough to sort and to broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    pos = F.col("_off") + (F.col("_mid") - F.shiftleft("_part", _PART_BITS)) + F.lit(start)
    return (ranged.join(F.broadcast(offsets), "_part").withColumn(index_col, pos.cast("bigint"))
            .drop("_mid", "_part", "_off")), total


def with_dense_index(df: DataFrame, order_cols: list, index_col: str = "idx",
                     start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """:func:`dense_index` without the count."""
    return dense_index(df, order_cols, index_col, start, num_partitions)[0]


def _values_at(values: DataFrame, ranks: list[int], n: int) -> dict[int, float]:
    """The values (column ``_v``, not null) at 0-based ``ranks`` of their order.

    Each rank has a bracket [a, b] that holds it, with the number of values below
    a and inside.  Approximate percentiles propose a narrower one, an exact count
    accepts it; when no bracket holds more than BRACKET_ROWS values (or only one
    value), the distinct values inside are ranked.  Every step is an aggregate.
    """
    v = F.col("_v")
    inside = lambda x: (v >= F.lit(x["a"])) & (v <= F.lit(x["b"]))
    low, high = values.agg(F.min("_v"), F.max("_v")).first()
    state = {r: {"a": low, "b": high, "below": 0, "n": n} for r in ranks}

    while wide := {r: x for r, x in state.items() if x["n"] > BRACKET_ROWS and x["a"] < x["b"] and not x.get("stuck")}:
        ask = []
        for r, x in wide.items():
            at, slack = (r - x["below"] + 0.5) / x["n"], 2 / ACCURACY
            ask.append(F.percentile_approx(F.when(inside(x), v), F.array(F.lit(max(0.0, at - slack)), F.lit(min(1.0, at + slack))), ACCURACY))
        ends = values.agg(*[c.alias(f"e{i}") for i, c in enumerate(ask)]).first()
        new = {r: {"a": e[0], "b": e[1]} for r, e in zip(wide, ends)}
        counts = values.agg(*[c for x in new.values() for c in (F.count_if(v < F.lit(x["a"])), F.count_if(inside(x)))]).first()
        for i, (r, x) in enumerate(new.items()):
            x |= {"below": counts[2 * i], "n": counts[2 * i + 1]}
            if x["below"] <= r < x["below"] + x["n"] and x["n"] < state[r]["n"]:
                state[r] = x
            else:
                state[r]["stuck"] = True
    out = {r: x["a"] for r, x in state.items() if x["a"] == x["b"]}
    rest = {r: x for r, x in state.items() if r not in out}
    if rest:
        of = F.explode(F.filter(F.array(*[F.when(inside(x), F.lit(r).cast("bigint")) for r, x in rest.items()]), lambda r: r.isNotNull()))
        upto = Window.partitionBy("_r").orderBy("_v")
        counted = values.select("_v", of.alias("_r")).groupBy("_r", "_v").agg(F.count("*").alias("_n"))
        below = F.create_map(*[c for r, x in rest.items() for c in (F.lit(r).cast("bigint"), F.lit(x["below"]).cast("bigint"))])
        end = F.sum("_n").over(upto) + F.element_at(below, F.col("_r"))
        found = (counted.withColumn("_end", end).where((F.col("_end") > F.col("_r")) & (F.col("_end") - F.col("_n") <= F.col("_r"))))
        out |= {row["_r"]: row["_v"] for row in found.select("_r", "_v").collect()}      # one row a rank
    return out


def exact_quantiles(df: DataFrame, value_col: str, probs: dict[str, float]) -> DataFrame:
    """One-row DataFrame with the exact linear-interpolated quantile for each
    ``name -> p`` (numpy's default method, DuckDB ``quantile_cont``): two ranks a
    quantile, found by narrowing brackets (no sort of the table, no stage
    table)."""
    spark = df.sparkSession
    values = df.select(F.col(value_col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    n = values.count()
    schema = ", ".join(f"`{k}` double" for k in probs)
    if n == 0:
        return spark.createDataFrame([tuple(None for _ in probs)], schema)
    at = {name: p * (n - 1) for name, p in probs.items()}
    value = _values_at(values, sorted({f(x) for x in at.values() for f in (math.floor, math.ceil)}), n)
    row = tuple(value[math.floor(x)] + (value[math.ceil(x)] - value[math.floor(x)]) * (x - math.floor(x)) for x in at.values())
    return spark.createDataFrame([row], schema)


def maybe_broadcast(df: DataFrame, n_rows: int, row_bytes: int = 16, max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` when its exact size, ``n_rows`` rows of ``row_bytes``, is
    within ``max_bytes``; beyond it, leave the join to a shuffle."""
    return F.broadcast(df) if n_rows * row_bytes <= (BROADCAST_BYTES if max_bytes is None else max_bytes) else df


def top_n_per_group(df: DataFrame, group_cols: list, order_cols: list[Column], n,
                    rank_col: str = "rank") -> DataFrame:
    """``row_number`` top-n; with a literal ``n`` Catalyst plans a
    ``WindowGroupLimit`` that trims each partition before the shuffle."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    limit = F.lit(n) if isinstance(n, int) else n
    return ranked.where(F.col(rank_col) <= limit).withColumn(
        rank_col, F.col(rank_col).cast("bigint"))
