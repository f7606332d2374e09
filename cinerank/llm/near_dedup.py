"""Operator 6, SimHash near-dedup with pigeonring filtering.

Fingerprints are cut in max_distance + 1 boxes on a ring.  By the pigeonring
principle two fingerprints within max_distance have a box from which every chain
of l consecutive boxes differs in at most l * max_distance / boxes bits: none in
the first box, one in the first two, two in the first three, and so on.  The
first two steps of a chain are the join key; the longer ones prune the pairs that
share it, and only what is left gets the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, connected_components, joined_words, map_arrow, restored, shielded, skew_join, stage

BITS = 64
#: Fingerprints of a key that a task compares with each other; further ones of
#: the key take the way of ``_dense_links``, whose work grows in proportion.
BLOCK = 20_000
#: Runs up to this size are compared in one go, longer ones member by member.
SHORT = 12


def simhash(text: str | None, shingle: int) -> int:
    """Fingerprint (unsigned) of the word shingles, repeats included: a bit is set
    when over half of the shingles' XXH64 (seed 42) have it; no words: zero."""
    joined, starts, ends = joined_words(text, lower=True)
    if not len(starts):
        return 0
    size = min(shingle, len(starts))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:len(starts) - size + 1].tolist(), ends[size - 1:].tolist())),
                         "<u8", len(starts) - size + 1)
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


class Ring:
    """The boxes of a fingerprint and the keys of their chains."""

    def __init__(self, max_distance: int):
        self.n = max_distance + 1
        edges = [k * BITS // self.n for k in range(self.n + 1)]
        self.low = [np.uint64(e) for e in edges[:-1]]
        self.width = [b - a for a, b in zip(edges, edges[1:])]
        self.mask = [np.uint64(((1 << w) - 1) << int(lo)) for w, lo in zip(self.width, self.low)]
        #: (first box, bit that differs in the second or -1): what a key stands for.
        self.kinds = [(i, j) for i in range(self.n) for j in ([-1] if self.n == 1 else [-1, *range(self.width[(i + 1) % self.n])])]

        #: The bits that are a kind's key: the first box, and the second but for that bit.
        self.masks = []
        for i, j in self.kinds:
            mask = self.mask[i] | self.mask[(i + 1) % self.n]
            if j >= 0:
                mask &= ~(np.uint64(1) << (self.low[(i + 1) % self.n] + np.uint64(j)))
            self.masks.append(mask)

    def linked(self, kind: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether fingerprints that share a key of this kind are linked by it: they
        differ in the bit left out, and each longer chain stays in its budget (the
        longest is the whole ring: the full Hamming check)."""
        i, j = self.kinds[kind]
        differ = a ^ b
        chain = self.mask[i] | self.mask[(i + 1) % self.n]
        ok = np.ones(differ.shape, bool) if j < 0 else \
            (differ >> (self.low[(i + 1) % self.n] + np.uint64(j)) & np.uint64(1)).astype(bool)
        for length in range(2, self.n + 1):
            chain |= self.mask[(i + length - 1) % self.n]
            ok &= np.bitwise_count(differ & chain) <= length * (self.n - 1) // self.n
        return ok

    def midpoints(self, kind: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, far, node): the fingerprints' neighbours within half the distance
        that may be left outside the key, rounded down (far = 0) or up (far = 1).

        Two of one key that share a node, one of them by far = 0, are within
        max_distance; and two that are linked share such a node."""
        i, j = self.kinds[kind]
        key = self.mask[i] | self.mask[(i + 1) % self.n]
        left = self.n - 1 - (j >= 0)
        if j >= 0:
            prints = prints & ~(np.uint64(1) << (self.low[(i + 1) % self.n] + np.uint64(j)))
        free = [np.uint64(1) << np.uint64(k) for k in range(BITS) if not int(key) >> k & 1]
        nodes = []

        def spread(node: np.ndarray, radius: int, first: int, far: int) -> None:
            nodes.append((far, node))
            for k in range(first, len(free) if radius else first):
                spread(node ^ free[k], radius - 1, k + 1, far)

        for far, radius in enumerate(sorted({left // 2, left - left // 2})):
            spread(prints, radius, 0, far)
        return (np.tile(np.arange(len(prints)), len(nodes)), np.repeat(np.array([f for f, _ in nodes], np.int32), len(prints)),
                np.concatenate([x for _, x in nodes]))


def forest(ring: Ring, kind: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the block's links connect: at most one a member."""
    left, ends = np.arange(len(prints)), ([], [])
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            hit = ring.linked(kind, prints[left], prints[at])
            if hit.any():
                got, left = left[hit], left[~hit]
                ends[0].append(np.full(len(got), prints[at]))
                ends[1].append(prints[got])
                queue.extend(got)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.uint64) for x in ends)


def _block_links(ring: Ring, kind: np.ndarray, key: np.ndarray, prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links within the (sorted, whole) runs of equal kind and key."""
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (kind[1:] != kind[:-1])])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(key)))
    short = np.repeat((size > 1) & (size <= SHORT), size)
    run = np.cumsum(new)
    out = []
    kept = np.flatnonzero(short)
    run, kinds, own = run[kept], kind[kept], prints[kept]
    for step in range(1, SHORT):
        same = np.flatnonzero(run[step:] == run[:-step])
        if not len(same):
            break
        for nr in np.unique(kinds[same]):
            pair = same[kinds[same] == nr]
            hit = pair[ring.linked(nr, own[pair], own[pair + step])]
            out.append((own[hit], own[hit + step]))
    for k in np.flatnonzero(size > SHORT):
        out.append(forest(ring, int(kind[at[k]]), prints[at[k]:at[k] + size[k]]))
    return out


SCANNED = "kind int, a long, b long"


def by_key(prints: DataFrame, masks: list[np.uint64]) -> DataFrame:
    """``prints`` (column fp) once a kind, dealt and sorted by kind and key.  The key
    is the fingerprint's bits in the kind's mask, so it isn't shuffled with it."""
    key = F.col("fp").bitwiseAND(F.element_at(F.array(*[F.lit(int(m.astype(np.int64))) for m in masks]), F.col("kind") + 1))
    return (prints.withColumn("kind", F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))))
            # the key first: its bits decide most comparisons of the sort
            .repartition(F.col("kind"), key).sortWithinPartitions(key, F.col("kind"), F.col("fp")))


def _scan_blocks(prints: DataFrame, ring: Ring) -> DataFrame:
    """Links (kind -1, two fingerprints) of the blocks, and the members (kind, key,
    fingerprint) of blocks of more than BLOCK."""
    target = arrow_schema(prints.sparkSession, SCANNED)
    masks = np.array(ring.masks, np.uint64)

    def rows(kind, a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(x), f.type) for x, f in zip((kind, a, b), target)], schema=target)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        dense = None                                       # the (kind, key) that is passed on

        def links(part):
            for a, b in _block_links(ring, *part) if len(part[0]) else ():
                if len(a):
                    yield rows(np.full(len(a), -1, np.int32), a.view(np.int64), b.view(np.int64))

        for batch in batches:
            own, of = batch["fp"].to_numpy().view(np.uint64), batch["kind"].to_numpy()
            new = [of, (own & masks[of]).view(np.int64), own]
            kind, key, prints = (np.concatenate([h, n]) for h, n in zip(held, new))
            if dense is not None:                          # the block goes on here
                more = int(np.searchsorted(~((kind == dense[0]) & (key == dense[1])), True))
                if more:
                    yield rows(kind[:more], key[:more], prints[:more].view(np.int64))
                kind, key, prints = kind[more:], key[more:], prints[more:]
                if len(key):
                    dense = None
            if not len(key):
                held = [kind, key, prints]
                continue
            last = int(np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (kind[1:] != kind[:-1])]))[-1])
            yield from links((kind[:last], key[:last], prints[:last]))
            held = [kind[last:], key[last:], prints[last:]]
            if len(held[0]) > BLOCK:
                dense = (held[0][0], held[1][0])
                yield rows(held[0], held[1], held[2].view(np.int64))
                held = [x[:0] for x in held]
        yield from links(held)

    return by_key(prints.select("fp"), ring.masks).mapInArrow(scan, SCANNED)


def _dense_links(members: DataFrame, ring: Ring) -> DataFrame:
    """Links of large blocks without comparing pairs: members are joined at the
    midpoints between them, each node's to its first (in proportion to the block)."""
    def expand(batch):
        kinds, keys, prints = batch["kind"].to_numpy(), batch["a"].to_numpy(), batch["b"].to_numpy().view(np.uint64)
        out = {k: [] for k in ("kind", "key", "far", "node", "fp")}
        for nr in np.unique(kinds):
            at = np.flatnonzero(kinds == nr)
            row, far, node = ring.midpoints(int(nr), prints[at])
            for column, x in zip(out.values(), (kinds[at][row], keys[at][row], far, node.view(np.int64), prints[at][row].view(np.int64))):
                column.append(x)
        return {k: np.concatenate(v) for k, v in out.items()}

    nodes = map_arrow(members.repartition(F.xxhash64("kind", "a", "b")), expand, "kind int, key long, far int, node long, fp long",
                      max_rows=1000)                        # hundreds of rows a fingerprint
    schema = "a long, b long"
    target = arrow_schema(members.sparkSession, schema)

    def stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, first = None, None
        for batch in batches:
            pairs = []
            for kind, key, node, far, fp in zip(*(batch[c].to_pylist() for c in ("kind", "key", "node", "far", "fp"))):
                if (kind, key, node) != own:
                    own, first = (kind, key, node), fp if far == 0 else None
                elif first is not None and fp != first:
                    pairs.append((first, fp))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*pairs) if pairs else [[], []], target)], schema=target)

    return (nodes.repartition("kind", "key", "node").sortWithinPartitions("kind", "key", "node", "far", "fp")
            .mapInArrow(stars, schema))


def fingerprint_components(prints: DataFrame, max_distance: int) -> DataFrame:
    """(fp, component) of the fingerprints (distinct, long) that have a link."""
    ring = Ring(max_distance)
    scanned = stage(_scan_blocks(prints, ring))
    links = scanned.where("kind < 0").select("a", "b")
    dense = scanned.where("kind >= 0")
    if not dense.isEmpty():
        links = links.unionByName(_dense_links(dense, ring))
    return connected_components(links).select(F.col("node").alias("fp"), "component")


def near_dedup(docs: DataFrame, shingle: int = 4, max_distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, text_md5, fingerprint (16 hex digits),
    component_id (the smallest id that is reached over links of at most
    ``max_distance`` differing bits, its own included) and kept.

    Of a component the row with the smallest id (null last, then the smallest
    text_md5) is kept; rows repeated with that id and text are all marked kept
    (``keep_one`` leaves one of them).  Texts of fewer than ``shingle`` words have
    their whole word sequence as the one shingle; null texts and texts without
    words have fingerprint zero, and are linked by it like any other.
    component_id is null where no row of a component has an id.  An empty table
    gives an empty result.  Other columns aren't read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_md5"),
                       F.col(text_col).alias("text"))

    def prints(batch):
        own = np.array([simhash(t, shingle) for t in batch["text"].to_pylist()], np.uint64)
        return {"id": batch["id"], "text_md5": batch["text_md5"], "fp": own.view(np.int64)}

    found = stage(map_arrow(rows, prints, f"id {id_type}, text_md5 string, fp long"))
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_md5"))
    # Copies, and whatever else has the same fingerprint, shrink to one row in the map tasks.
    classes = stage(found.groupBy("fp").agg(F.count("*").alias("_rows"), best.alias("best")))
    linked = stage(classes.join(fingerprint_components(classes, max_distance), "fp"))
    roots = linked.groupBy("component").agg(F.min("best").alias("best"), F.count("*").alias("_n"))
    joined = skew_join(linked.drop("best"), stage(roots), "component", "_n").select("fp", "_rows", "best")
    verdicts = stage(joined.unionByName(classes.join(linked.select("fp"), "fp", "left_anti").select("fp", "_rows", "best")))
    return (skew_join(found, verdicts, "fp", "_rows")
            .select(F.col("id").alias(id_col), "text_md5", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    F.col("best.id").alias("component_id"),
                    (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("text_md5") == F.col("best.text_md5"))).alias("kept")))


def keep_one(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (its columns, whatever their names) with one row of each component;
    of rows equal in id and text one.  An empty table stays empty."""
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    kept = verdicts.where("kept").select(key(id_col).alias("_id"), F.col("text_md5").alias("_md5")).distinct()
    rows, names = shielded(docs)
    return (rows.withColumn("_id", key(names[id_col])).withColumn("_md5", F.md5(F.coalesce(F.col(names[text_col]), F.lit(""))))
            .join(kept, ["_id", "_md5"], "left_semi").dropDuplicates(["_id", "_md5"]).select(*restored(names)))


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_dedup(docs).select("doc_id", "fingerprint", "component_id")
