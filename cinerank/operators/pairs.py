"""All pairs of a similarity, packed without loss: about a tenth of the bytes of plain rows.

A similarity is dot / (norm * norm) of two users' ratings, and the dot product is a small
whole number where the double has eight bytes.  The pairs are kept in runs as the grid
computes them: a user, some neighbours in order with squared norms, and a dot product each
(Parquet's dictionary takes a few bits for it, and zstd next to nothing for the neighbours that
run after run repeats).  Two blocks meet once; their runs stand for both directions.  Unpacked
pairs have the bits of those that the grid returns as rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN_PAIRS = 512                 # most pairs of a run: Parquet's reader holds 4,096 runs at a time
RUN_SCHEMA = ("user_id bigint, square bigint, neighbors array<bigint>, neighbor_squares array<bigint>, dots array<bigint>, "
              "unit bigint, both boolean")
_LONGS = pa.list_(pa.int64())
_RUN = pa.schema([("user_id", pa.int64()), ("square", pa.int64()), ("neighbors", _LONGS), ("neighbor_squares", _LONGS), ("dots", _LONGS),
                  ("unit", pa.int64()), ("both", pa.bool_())])


def pack_runs(users, squares, neighbors, neighbor_squares, li, ri, dot, unit: int, both: bool) -> pa.RecordBatch:
    """Runs of the pairs ``li``, ``ri`` (positions, by ``li``) of users and neighbours with
    squared norms; ``dot``: multiples of ``unit``."""
    first = np.flatnonzero(np.r_[True, li[1:] != li[:-1]])
    place = np.arange(len(li)) - np.repeat(first, np.diff(np.r_[first, len(li)]))
    first = np.flatnonzero(place % RUN_PAIRS == 0)
    ends = pa.array(np.r_[first, len(li)].astype(np.int32))
    user = li[first]
    lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (neighbors[ri], neighbor_squares[ri], dot // unit)]
    return pa.RecordBatch.from_arrays([pa.array(users[user]), pa.array(squares[user]), *lists, pa.array(np.full(len(user), unit)),
                                       pa.array(np.full(len(user), both))], schema=_RUN)


def pairs_of(runs: DataFrame, users: list[int] | None = None) -> DataFrame:
    """The pairs of packed runs as rows; with ``users`` those of these users alone."""
    there, back = runs, runs.where("both")
    if users is not None:
        ids = F.array(*[F.lit(u).cast("bigint") for u in users]).cast("array<bigint>")
        there = there.where(F.array_contains(ids, F.col("user_id")))
        # neighbours are in order: most runs are told by their ends
        back = back.where((F.element_at("neighbors", 1) <= F.array_max(ids)) & (F.element_at("neighbors", -1) >= F.array_min(ids))
                          & F.arrays_overlap("neighbors", ids))

    def rows(some: DataFrame, user: str, neighbor: str) -> DataFrame:
        at = F.col("_i")
        # Same operation order as in the grid, whose product doesn't depend on the direction.
        sim = (F.col("_dot") * F.col("unit")).cast("double") / (F.sqrt(F.col("square").cast("double")) * F.sqrt(F.get("neighbor_squares", at).cast("double")))
        return (some.select("user_id", "square", "neighbors", "neighbor_squares", "unit", F.posexplode("dots").alias("_i", "_dot"))
                .select(F.col("user_id").alias(user), F.get("neighbors", at).alias(neighbor), sim.alias("similarity")))

    sims = rows(there, "user_id", "neighbor_id").unionByName(rows(back, "neighbor_id", "user_id")).select("user_id", "neighbor_id", "similarity")
    return sims if users is None else sims.where(F.array_contains(ids, F.col("user_id")))
