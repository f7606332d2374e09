"""Operator 5, packing: cutting-stock column generation.

Documents are tokenized in the tasks; what reaches the driver is only the
histogram of piece lengths (at most capacity numbers).  There short pieces are
put together in bundles that fill whole units, and a linear
program over packing patterns is solved by column generation, a knapsack dynamic
program pricing the columns; its patterns are rounded down, the few pieces left
get patterns of their own, and the pieces, ranked by length, take their places
in the patterns as a Spark job.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stage
from .tokenizing import tokenizer_path, word_encoder


def best_pattern(value: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable multiset of sizes within capacity."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    sorted_sizes, sorted_value = sizes[order], value[order]
    upto = np.searchsorted(sorted_sizes, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if upto[c]:
            gain = best[c - sorted_sizes[:upto[c]]] + sorted_value[:upto[c]]
            k = int(gain.argmax())
            if gain[k] > best[c] + 1e-12:
                best[c], pick[c] = gain[k], k
    counts, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            counts[order[pick[c]]] += 1
            c -= int(sorted_sizes[pick[c]])
    return float(best[capacity]), counts


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int,
                   gap: float = 1e-4, max_rounds: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, uses): the linear program min sum(uses), patterns.T @ uses =
    demand, by revised simplex with generated columns.  Stops when the best
    column's price shows that the sum is within ``gap`` of its bound."""
    n = len(sizes)
    patterns = np.diag(capacity // sizes).astype(np.int64)
    inverse = np.diag(1.0 / np.diag(patterns))
    uses = demand / np.diag(patterns)
    for _ in range(max_rounds):
        price, column = best_pattern(inverse.sum(axis=0), sizes, capacity)
        if price <= 1 + gap:
            break
        step = inverse @ column
        ratio = np.full(n, np.inf)
        up = step > 1e-9
        ratio[up] = uses[up] / step[up]
        leave = int(ratio.argmin())
        uses = np.maximum(uses - ratio[leave] * step, 0.0)
        uses[leave] = ratio[leave]
        pivot = inverse[leave] / step[leave]
        inverse -= np.outer(step, pivot)
        inverse[leave] = pivot
        patterns[leave] = column
    return patterns, uses


def fill_rest(sizes: np.ndarray, rest: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns of one use for the pieces that rounding leaves: again the best
    knapsack of what is there, fullest first (longest first within a bin)."""
    rest, out = rest.copy(), []
    order = np.argsort(-sizes, kind="stable")
    while rest.any():
        counts, room = np.zeros(len(sizes), np.int64), capacity
        for t in order:
            k = min(rest[t], room // sizes[t])
            counts[t] += k
            room -= k * sizes[t]
        times = int(min(rest[t] // counts[t] for t in np.flatnonzero(counts)))
        out += [counts] * times
        rest -= times * counts
    return out


def plan_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """[(pattern as {size: count}, uses)] that place exactly the histogram's pieces."""
    if not histogram:
        return []
    sizes = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[s] for s in sizes], np.int64)
    patterns, uses = solve_patterns(sizes, demand.astype(float), capacity)
    whole = np.floor(uses + 1e-6).astype(np.int64)
    while ((left := demand - patterns.T @ whole) < 0).any():       # rounding up by 1e-6 was too much somewhere
        whole[np.flatnonzero((patterns[:, left < 0] > 0).any(axis=1) & (whole > 0))[0]] -= 1
    plan = [(p, int(k)) for p, k in zip(patterns, whole) if k]
    plan += [(p, 1) for p in fill_rest(sizes, left, capacity)]
    return [({int(s): int(a) for s, a in zip(sizes, p) if a}, k) for p, k in plan]


def bundle_pieces(histogram: dict[int, int], capacity: int, unit: int) -> list[tuple[int, dict[int, int], int]]:
    """[(units, bundle as {length: count}, uses)] that hold exactly the histogram's
    pieces.  Pieces of a length go together as many as lose little to the rounding
    up to ``unit`` (the fewest that lose under 1 in 128, or else the least share),
    within an eighth of the capacity; what a length leaves is put in bundles with
    others, longest first.  Longer pieces are alone."""
    units = lambda n: -(-n // unit)
    most = capacity // 8
    out, rest = [], []
    for length, n in sorted(histogram.items(), reverse=True):
        lost = {m: (units(m * length) * unit - m * length) / (m * length) for m in range(1, max(1, min(most // length, unit)) + 1)}
        m = next((m for m in lost if lost[m] < 1 / 128), min(lost, key=lost.get))
        if n >= m:
            out.append((units(m * length), {length: m}, n // m))
        rest += [length] * (n % m)                        # under ``unit`` pieces a length
    open_: list[tuple[int, dict[int, int]]] = []
    for length in rest:
        k = next((k for k, (full, _) in enumerate(open_) if full + length <= most), None)
        full, own = (0, {}) if k is None else open_[k]
        own[length] = own.get(length, 0) + 1
        if k is None:
            open_.append((length, own))
        else:
            open_[k] = full + length, own
    return out + [(units(full), own, 1) for full, own in open_]


def plan_lengths(histogram: dict[int, int], capacity: int, unit: int) -> list[tuple[dict[int, int], int]]:
    """[(pattern as {length: count}, uses)] that place exactly the histogram's pieces."""
    bundles: dict[int, list[list]] = {}
    for size, own, uses in bundle_pieces(histogram, capacity, unit):
        bundles.setdefault(size, []).append([own, uses])
    out = []
    for pattern, uses in plan_patterns({s: sum(n for _, n in b) for s, b in bundles.items()}, capacity // unit):
        while uses:
            # As many uses as the bundles at hand of every size are enough for; else one with several sorts of them.
            times = max(1, min([uses, *(bundles[s][-1][1] // a for s, a in pattern.items())]))
            lengths: dict[int, int] = {}
            for size, a in pattern.items():
                while a:
                    own, left = bundles[size][-1]
                    k = min(a, left // times)
                    for length, n in own.items():
                        lengths[length] = lengths.get(length, 0) + k * n
                    bundles[size][-1][1] -= k * times
                    a -= k
                    if not bundles[size][-1][1]:
                        bundles[size].pop()
            out.append((lengths, times))
            uses -= times
    return out


def piece_table(docs: DataFrame, path: str, capacity: int, end_id: int, payload: str,
                id_col: str, text_col: str) -> DataFrame:
    """Tokenize whole texts and cut them every ``capacity`` tokens."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).alias("text"))
    end = np.array([end_id], "<u4").tobytes()
    kind = "ids array<long>" if payload == "ids" else "ids_crc32 long"

    def cut(batch):
        encoder = word_encoder(path)
        out = {k: [] for k in ("uid", "id", "start", "length", "doc_tokens", kind.split()[0])}
        for uid, doc, text in zip(*(batch[c].to_pylist() for c in ("uid", "id", "text"))):
            ids = encoder.encode(text) + end
            total = len(ids) // 4
            for start in range(0, total, capacity):
                piece = ids[4 * start:4 * (start + capacity)]
                value = np.frombuffer(piece, "<u4").astype(np.int64) if payload == "ids" else zlib.crc32(piece)
                for column, x in zip(out.values(), (uid, doc, start, len(piece) // 4, total, value)):
                    column.append(x)
        return out

    return map_arrow(rows, cut, f"uid long, id long, start long, length long, doc_tokens long, {kind}")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = 4096, unit: int = 16,
                   end_id: int = 2, payload: str = "ids", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of ``docs`` placed in sequences of at most ``capacity`` tokens:
    ``id_col``, start, length, doc_tokens, sequence_id, offset and the payload,
    ``ids`` (the piece's token ids) or ``ids_crc32`` (their checksum).

    A document is its text's ids and ``end_id``; null and empty texts are the
    ``end_id`` alone.  Documents are cut only every ``capacity`` tokens.  Lengths
    count as rounded up to ``unit``, so a sequence loses under ``unit`` tokens a
    piece to that; short pieces count as bundles (see ``bundle_pieces``).  Repeated rows and null ids are documents of their own (ids
    are only carried along).  An empty table gives an empty result.  Other
    columns aren't read.
    """
    pieces = stage(piece_table(docs, path or tokenizer_path("word_bpe_49k.json"), capacity, end_id, payload, id_col, text_col))
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}   # at most capacity rows
    plan = plan_lengths(histogram, capacity, unit)

    # Where each pattern's pieces of a length start, by the length's rank: a few numbers a pattern and length.
    first, next_rank, sequence = [], dict.fromkeys(histogram, 0), 0
    for pattern, uses in plan:
        slot = 0
        for size, a in sorted(pattern.items(), reverse=True):
            first.append((size, next_rank[size], a, sequence, slot))
            next_rank[size] += a * uses
            slot += a
        sequence += uses
    first.sort()
    table = np.array(first, np.int64).reshape(-1, 5)

    # Ranks within a length, without one task for a frequent one: parts, their offsets, ranks in the part.
    parts = max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    light = pieces.withColumn("part", F.pmod(F.xxhash64("uid", "start"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (light.groupBy("length", "part").agg(F.count("*").alias("n"))
               .select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    ranked = (light.withColumn("nth", F.row_number().over(Window.partitionBy("length", "part").orderBy("uid", "start")))
              .join(offsets, ["length", "part"])
              .withColumn("rank", F.col("before") + F.col("nth") - 1).drop("part", "before", "nth"))

    carried = [(f.name, f.dataType.simpleString().replace("bigint", "long")) for f in pieces.schema]

    def place(batch):
        size, rank = (batch[c].to_numpy() for c in ("length", "rank"))
        # rows of ``table`` are sorted by length and first rank: the last row not above is the piece's
        key = table[:, 0].astype(np.uint64) << np.uint64(44) | table[:, 1].astype(np.uint64)
        row = table[np.searchsorted(key, size.astype(np.uint64) << np.uint64(44) | rank.astype(np.uint64), side="right") - 1]
        use, slot = np.divmod(rank - row[:, 1], row[:, 2])
        return {n: batch[n] for n, _ in carried} | {"sequence_id": row[:, 3] + use, "slot": row[:, 4] + slot}

    placed = map_arrow(ranked, place, ", ".join(f"{n} {t}" for n, t in carried) + ", sequence_id long, slot long")
    sofar = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("offset", F.coalesce(F.sum("length").over(sofar), F.lit(0)))
            .withColumnRenamed("id", id_col).drop("uid", "slot"))


def op5_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return (pack_documents(docs, payload="crc32")
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))
