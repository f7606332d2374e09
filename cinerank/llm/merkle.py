"""Operator 11, Merkle manifest of a dataset: bitmap-rank indexing.

A leaf's place in its source is a rank query: ids are kept as compressed bitmaps
of 2^16 ids (sorted array or bitmap with a popcount directory), made in each task
and merged per source; counts of a radix tree over the ids' upper bits say how
many leaves lie before a bitmap.  No sort orders the leaves.  The tree is then
reduced through slot arrays: leaves are dealt by (source, place / arity^levels)
into arrays indexed by the rest of the place, several levels a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import dense_index
from ..session import ship_package
from .common import arrow_schema, map_arrow, skew_join, stage

#: Low bits of an id inside a bitmap, and the most ids kept as a sorted array.
BITS, SPARSE = 16, 4096
#: Nodes of a slot array at most, and copies of a row made at once.
SLOTS, COPIES = 10_000, 4096
EXTRA = np.dtype([("low", "<u2"), ("more", "<i8")])


def _joined_cuts(cuts: list[int], together: int) -> list[int]:
    """``cuts`` without those between runs that have ``together`` rows or fewer in all."""
    if not together:
        return cuts
    out = cuts[:1]
    for at, to in zip(cuts[1:], cuts[2:]):
        if to - out[-1] > together:
            out.append(at)
    return out + cuts[1:][-1:]


def map_runs(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], dict | None], schema: str, order: tuple = (), tasks: int | None = None,
             together: int = 0) -> DataFrame:
    """Deal ``df`` by ``keys`` (not null), in ``tasks`` if given, and call ``fn`` with the rows of each key:
    one worker call a partition instead of one a group, so small groups are cheap.
    A key's rows are held together: they must be bounded by the caller.  Whole keys of up
    to ``together`` rows in all may be given to ``fn`` at once."""
    ship_package(df.sparkSession)
    target = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, made = [], [], 0

        def flush():
            done = [pa.RecordBatch.from_arrays([pa.array(o[f.name], f.type) for f in target], schema=target) for o in out]
            out.clear()
            yield from pa.Table.from_batches(done).combine_chunks().to_batches() if done else ()

        def call(table):
            if (got := fn(table)) is not None:
                out.append(got)
                return len(got[target[0].name])
            return 0

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            new = np.zeros(table.num_rows - 1, bool)
            for k in keys:
                new |= pc.not_equal(table[k].slice(1), table[k].slice(0, table.num_rows - 1)).to_numpy()
            cuts = _joined_cuts([0, *(np.flatnonzero(new) + 1).tolist()], together)
            for a, b in zip(cuts, cuts[1:]):
                made += call(table.slice(a, b - a))
                if made >= 10_000:
                    yield from flush()
                    made = 0
            held = table.slice(cuts[-1]).to_batches()
        if held:
            call(pa.Table.from_batches(held).combine_chunks())
        yield from flush()

    return df.repartition(*([tasks] if tasks else []), *keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


# ---- bitmaps and ranks -------------------------------------------------------

def pack_ids(low: np.ndarray) -> tuple[bytes, bytes]:
    """(compressed ids, popcount directory) of sorted distinct uint16 ids: an
    array up to SPARSE of them, else a bitmap with the count before each word."""
    if len(low) <= SPARSE:
        return low.astype("<u2").tobytes(), b""
    words = np.packbits(np.bincount(low, minlength=1 << BITS).astype(bool), bitorder="little").view("<u8")
    count = np.bitwise_count(words).astype("<u4")
    return words.tobytes(), (np.cumsum(count, dtype="<u4") - count).tobytes()


def unpack_ids(ids: bytes, directory: bytes) -> np.ndarray:
    if not directory:
        return np.frombuffer(ids, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(ids, np.uint8), bitorder="little")).astype("<u2")


def rank_ids(ids: bytes, directory: bytes, low: np.ndarray) -> np.ndarray:
    """How many of the ids are below each of ``low``."""
    if not directory:
        return np.searchsorted(np.frombuffer(ids, "<u2"), low.astype("<u2"))
    word, bit = low >> 6, (low & 63).astype(np.uint64)
    below = np.frombuffer(ids, "<u8")[word] & ((np.uint64(1) << bit) - np.uint64(1))
    return np.frombuffer(directory, "<u4")[word] + np.bitwise_count(below).astype(np.int64)


BITMAP = "g string, high long, ids binary, directory binary, extra binary, total long"


def _bitmap(g: str, high: int, low: np.ndarray, extra: np.ndarray) -> dict:
    ids, directory = pack_ids(low)
    return {"g": [g], "high": [high], "ids": [ids], "directory": [directory], "extra": [extra.tobytes()],
            "total": [len(low) + int(extra["more"].sum())]}


def _extra(low: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros(int((n > 1).sum()), EXTRA)
    out["low"], out["more"] = low[n > 1], n[n > 1] - 1
    return out


def id_bitmaps(rows: DataFrame) -> DataFrame:
    """Bitmaps of ``rows`` (g, key, n; one row a key of a group): each task's are
    merged by group and upper bits.  ``extra`` has the repeats of ids with n > 1."""
    def partial(batch):
        code = batch["g"].dictionary_encode()
        names, code = code.dictionary.to_pylist(), code.indices.to_numpy()
        key, n = batch["key"].to_numpy(), batch["n"].to_numpy()
        high, low = key >> BITS, key & ((1 << BITS) - 1)
        order = np.lexsort((low, high, code))
        code, high, low, n = code[order], high[order], low[order], n[order]
        cut = np.flatnonzero((np.diff(code) != 0) | (np.diff(high) != 0)) + 1
        made = [_bitmap(names[code[a]], int(high[a]), low[a:b], _extra(low[a:b], n[a:b]))
                for a, b in zip([0, *cut], [*cut, len(code)])]
        return {c: [m[c][0] for m in made] for c in made[0]} if len(code) else None

    def merge(run):
        if run.num_rows == 1:
            return run.to_pydict()
        own = run.to_pydict()
        low = np.sort(np.concatenate([unpack_ids(i, d) for i, d in zip(own["ids"], own["directory"])]))
        extra = np.concatenate([np.frombuffer(x, EXTRA) for x in own["extra"]])
        return _bitmap(own["g"][0], own["high"][0], low.astype(np.int64), extra[np.argsort(extra["low"])])

    return map_runs(map_arrow(rows.select("g", "key", "n"), partial, BITMAP), ["g", "high"], merge, BITMAP)


def bitmap_starts(bitmaps: DataFrame) -> DataFrame:
    """``bitmaps`` with ``base``: the group's rows in smaller ids.  A radix tree over
    the upper bits, 16 at a time: each window orders at most 2^16 counts."""
    rows = bitmaps.select("g", "high", "total", F.shiftright("high", BITS).alias("h1"), F.shiftright("high", 2 * BITS).alias("h2"))

    def before(counts: DataFrame, within: list[str], by: str, name: str) -> DataFrame:
        w = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn(name, F.coalesce(F.sum("total").over(w), F.lit(0)))

    top = before(rows.groupBy("g", "h2").agg(F.sum("total").alias("total")), ["g"], "h2", "b2").drop("total")
    mid = before(rows.groupBy("g", "h2", "h1").agg(F.sum("total").alias("total")), ["g", "h2"], "h1", "b1").drop("total")
    low = before(rows, ["g", "h2", "h1"], "high", "b0")
    bases = (low.join(mid, ["g", "h2", "h1"]).join(top, ["g", "h2"])
             .select("g", "high", (F.col("b0") + F.col("b1") + F.col("b2")).alias("base")))
    return bitmaps.join(bases, ["g", "high"])


def rank_starts(rows: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """``rows`` (staged: g string, key long, n long and others; one row a key of a
    group) with ``start``: how many rows of the group have smaller keys, plus the
    group's ``first`` (table g, first)."""
    bitmaps = bitmap_starts(stage(id_bitmaps(rows)))
    if first is not None:
        bitmaps = (bitmaps.join(first, "g", "left").withColumn("base", F.col("base") + F.coalesce("first", F.lit(0))).drop("first"))
    names = rows.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", start long"
    both = rows.withColumn("high", F.shiftright("key", BITS)).unionByName(
        bitmaps.select("g", "high", "ids", "directory", "extra", "base"), allowMissingColumns=True)

    def rank(run):
        head = {c: run[c][0].as_py() for c in ("ids", "directory", "extra", "base")}
        run = run.slice(1)                                    # the bitmap's own row is first: a null key
        low = run["key"].to_numpy().astype(np.int64) & ((1 << BITS) - 1)
        extra = np.frombuffer(head["extra"], EXTRA)
        more = np.concatenate([[0], np.cumsum(extra["more"])])[np.searchsorted(extra["low"], low.astype("<u2"))]
        return ({c: run[c].combine_chunks() for c in names}
                | {"start": head["base"] + rank_ids(head["ids"], head["directory"], low) + more})

    return map_runs(both, ["g", "high"], rank, schema, order=(F.col("key").asc_nulls_first(),))


# ---- leaves and their places ---------------------------------------------------

def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, columns)), 256))


def _copies(rows: DataFrame, n: Column, name: str) -> DataFrame:
    """Each row ``n`` times, numbered from 0 as ``name``; no array exceeds COPIES or n / COPIES."""
    blocks = rows.withColumn("_n", n.cast("long")).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES))))
    first = F.col("_b") * COPIES
    return blocks.withColumn(name, F.explode(F.sequence(first, F.least(F.col("_n"), first + COPIES) - 1))).drop("_n", "_b")


def _leaf_places(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves with their place: g, pos, id, digest, shown; leaves a group: g, m).
    By id, null first; rows of one id by leaf, then by shown.  ``leaves`` is staged."""
    ids = stage(leaves.groupBy("g", "id").agg(
        F.count("*").alias("n"), F.min("digest").alias("digest"), F.max("digest").alias("_d"),
        F.min("shown").alias("shown"), F.max("shown").alias("_s"))
        .select("g", F.col("id").alias("key"), "n", "digest", "shown", ((F.col("digest") != F.col("_d")) | (F.col("shown") != F.col("_s"))).alias("tied")))
    no_id = ids.where("key is null")
    ranked = stage(rank_starts(ids.where("key is not null"), no_id.select("g", F.col("n").alias("first")))
                   .unionByName(no_id.withColumn("start", F.lit(0).cast("long"))))
    places = ranked.where("not tied").select("g", F.col("key").alias("id"), "digest", "shown", "start", "n")
    tied = ranked.where("tied")
    if not tied.isEmpty():
        # Different rows of one id: ranked among themselves by the leaf's first 64 bits, then by the rest.
        rows = leaves.withColumn("_k", F.xxhash64("g", "id"))
        table = tied.select(F.xxhash64("g", "key").alias("_k"), F.col("g").alias("_g"), F.col("key").alias("_id"), "start", F.col("n").alias("_n"))
        rows = (skew_join(rows, stage(table), "_k", "_n").where("g = _g and id <=> _id")
                .groupBy("g", "id", "digest", "shown").agg(F.count("*").alias("n"), F.first("start").alias("start"))
                .withColumn("of", F.concat(F.coalesce(F.col("id").cast("string"), F.lit("-")), F.lit(":"), F.col("g")))
                .withColumn("key", F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(-1 << 63).cast("long"))))
        rows = stage(rows.withColumn("inside", F.sum("n").over(Window.partitionBy("of", "key").orderBy("digest", "shown")) - F.col("n")))
        keys = stage(rows.groupBy(F.col("of").alias("g"), "key").agg(F.sum("n").alias("n")))
        before = rank_starts(keys).select(F.col("g").alias("of"), "key", F.col("start").alias("before"))
        places = places.unionByName(rows.join(before, ["of", "key"]).select(
            "g", "id", "digest", "shown", (F.col("start") + F.col("before") + F.col("inside")).alias("start"), "n"))
    leaves = _copies(places, F.col("n"), "copy").select("g", (F.col("start") + F.col("copy")).alias("pos"), "id", "digest", "shown")
    return stage(leaves), stage(ids.groupBy("g").agg(F.sum("n").alias("m")))


# ---- the tree --------------------------------------------------------------------

def parent(hexes: list[str]) -> str:
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


def climb(nodes: list[str], arity: int, levels: int) -> list[list[str]]:
    """The nodes and the ``levels`` levels above them."""
    out = [nodes]
    for _ in range(levels):
        out.append([parent(out[-1][i:i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def fold(digest: str, path: str) -> str:
    """The root that a digest and the siblings of a path (``own place:siblings`` a
    level, comma-joined) lead to."""
    for step in path.split(",") if path else ():
        own, others = step.split(":")
        at = int(own) * 64
        digest = hashlib.sha256((others[:at] + digest + others[at:]).encode()).hexdigest()
    return digest


def proof_digest(path: str) -> str:
    return hashlib.sha256("".join(step.split(":")[1] for step in path.split(",") if step).encode()).hexdigest()


def _slots(run: pa.Table, width: int) -> tuple[dict, pa.Table, np.ndarray, list[str]]:
    """The array's header, its node rows, their slots, and the digests by slot."""
    head, rows = {c: run[c][0].as_py() for c in ("g", "chunk", "levels", "path", "top")}, run.slice(1)
    slot = rows["pos"].to_numpy().astype(np.int64) % width
    nodes = [""] * len(slot)
    for at, digest in zip(slot.tolist(), rows["digest"].to_pylist()):
        nodes[at] = digest.hex()
    return head, rows, slot, nodes


def _paths(nodes: list[str], arity: int, levels: int, upper: str) -> list[str]:
    """Each node's path, whose last steps are ``upper``."""
    tree = climb(nodes, arity, levels)
    paths = [upper] * len(tree[-1])
    for level in tree[-2::-1]:
        new = []
        for i in range(len(level)):
            a = i - i % arity
            step = f"{i - a}:" + "".join(level[a:i] + level[i + 1:a + arity])
            new.append(f"{step},{paths[i // arity]}" if paths[i // arity] else step)
        paths = new
    return paths


class Forest:
    """Trees of the groups of ``nodes`` (g, pos, digest and others; ``sizes`` has
    their number m by g), reduced through slot arrays of arity^depth nodes."""

    def __init__(self, nodes: DataFrame, sizes: DataFrame, arity: int) -> None:
        depth = max(1, int(np.log(SLOTS) / np.log(arity) + 1e-9))
        self.arity, self.width = arity, arity ** depth
        self.rounds: list[tuple[DataFrame, DataFrame]] = []
        while (sizes.agg(F.max("m")).first()[0] or 1) > 1:
            m = F.col("m")
            levels = sum((F.when(m > arity ** k, 1).otherwise(0) for k in range(depth)), F.lit(0))
            heads = _copies(sizes, F.ceil(m / self.width), "chunk").select("g", "chunk", levels.cast("int").alias("levels"))
            self.rounds.append((nodes, heads))
            nodes = stage(map_runs(self._arrays(nodes, heads), ["g", "chunk"], self._top(), "g string, pos long, digest binary", (F.col("levels").desc_nulls_last(),)))
            sizes = stage(sizes.select("g", F.ceil(m / self.width).alias("m")))
        self.roots = nodes.select("g", "digest")

    def _arrays(self, nodes: DataFrame, heads: DataFrame) -> DataFrame:
        for c in ("path", "top"):
            heads = heads if c in heads.columns else heads.withColumn(c, F.lit(""))
        return heads.unionByName(nodes.withColumn("chunk", F.floor(F.col("pos") / self.width)), allowMissingColumns=True)

    def _top(self):
        arity, width = self.arity, self.width

        def top(run):
            head, _, _, nodes = _slots(run, width)
            return {"g": [head["g"]], "pos": [head["chunk"]], "digest": [bytes.fromhex(climb(nodes, arity, head["levels"])[-1][0])]}

        return top

    def descend(self, uppers: DataFrame, finish: Callable[[pa.Table, list[str], str], dict], schema: str) -> DataFrame:
        """From the roots' own paths (``uppers``: g, path, top) to those of the first
        nodes, of which ``finish`` (rows, paths, top) makes the result."""
        arity, width = self.arity, self.width

        def passed(rows, paths, top):
            return {"g": rows["g"].combine_chunks(), "pos": rows["pos"].combine_chunks(), "path": paths, "top": [top] * len(paths)}

        def down(make):
            def run(table):
                head, rows, slot, nodes = _slots(table, width)
                paths = _paths(nodes, arity, head["levels"], head["path"])
                return make(rows, [paths[s] for s in slot.tolist()], head["top"])
            return run

        uppers = uppers.withColumn("pos", F.lit(0).cast("long"))
        order = (F.col("levels").desc_nulls_last(),)
        for nr, (nodes, heads) in reversed(list(enumerate(self.rounds))):
            heads = heads.join(uppers.withColumnRenamed("pos", "chunk"), ["g", "chunk"])
            if nr:
                uppers = stage(map_runs(self._arrays(nodes, heads), ["g", "chunk"], down(passed), "g string, pos long, path string, top string", order))
            else:
                return map_runs(self._arrays(nodes, heads), ["g", "chunk"], down(finish), schema, order)
        raise ValueError("a forest of single nodes has no rounds")


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", columns: tuple = ("doc_id", "source", "lang", "n_chars", "text"),
                    shown: dict[str, Column] | None = None, arity: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``group_col``, pos (the leaf's place in
    its group, from 0), leaf, subroot (the group's), root, proof_sha256,
    folded_root and verified; digests are lowercase hex.

    A leaf is the sha256 of ``columns`` joined, each ``-`` if null, else its UTF-8
    byte count, ``:`` and the value.  Leaves of a group ascend by id; while a level
    has several nodes, each run of ``arity`` (the last one may be shorter, even
    one) becomes the sha256 of its hex digests.  The groups' subroots, null
    first, then bytewise, lead to root in the same way.  proof_sha256 is the sha256
    of the siblings from the leaf up to the root, left to right within a level.
    ``shown`` gives the values in which a row is presented for verification, by
    column (default: the row as it is): folded_root is what its leaf and the
    original siblings lead to, verified says if that is root.

    Null ids come first in their group, null groups form one.  Rows of one id are
    ordered by leaf; equal rows have successive places, so each has its own
    proof.  A group of one row has its leaf as subroot, and a table of one row
    as root (the proof is the sha256 of nothing).  Texts may be null, empty or
    of any length (hashed by Spark, row by row).  An empty table gives an empty
    result.  Other columns, whatever their names, aren't read.
    """
    shown = shown or {}
    row = [F.col(c) for c in columns]
    id_type, group_type = (docs.schema[c].dataType.simpleString() for c in (id_col, group_col))
    leaves = stage(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-")).alias("g"),    # null before all others
        F.col(id_col).cast("long").alias("id"), leaf_digest(row).alias("digest"),
        leaf_digest([shown.get(c, F.col(c)) for c in columns]).alias("shown")))
    nodes, sizes = _leaf_places(leaves)
    trees = Forest(nodes, sizes, arity)
    subroots, n = dense_index(trees.roots, [F.col("g")], "pos")
    subroots = stage(subroots)
    upper = Forest(stage(subroots.select(F.lit("").alias("g"), "pos", "digest")), docs.sparkSession.createDataFrame([("", n)], "g string, m long"), arity)
    root = (upper.roots.first() or {"digest": b""})["digest"].hex()

    def named(rows, paths, top):
        return {"pos": rows["pos"].combine_chunks(), "path": paths}

    if upper.rounds:
        first = docs.sparkSession.createDataFrame([("", "", "")], "g string, path string, top string")
        paths = stage(upper.descend(first, named, "pos long, path string"))
        paths = subroots.join(paths, "pos")
    else:
        paths = subroots.withColumn("path", F.lit(""))
    paths = stage(paths.select("g", "path", F.lower(F.hex("digest")).alias("top")))
    schema = "g string, id long, pos long, leaf string, subroot string, proof_sha256 string, folded_root string"

    def finish(rows, paths, top):
        return {"g": rows["g"].combine_chunks(), "id": rows["id"].combine_chunks(), "pos": rows["pos"].combine_chunks(),
                "leaf": [d.hex() for d in rows["digest"].to_pylist()], "subroot": [top] * len(paths),
                "proof_sha256": [proof_digest(p) for p in paths],
                "folded_root": [fold(d.hex(), p) for d, p in zip(rows["shown"].to_pylist(), paths)]}

    if trees.rounds:
        out = trees.descend(paths, finish, schema)
    else:                                                       # groups of one row each
        def single(batch):
            return finish(pa.Table.from_batches([batch]), batch["path"].to_pylist(), "") | {"subroot": batch["top"]}

        out = map_arrow(nodes.join(paths, "g"), single, schema)
    return out.select(F.col("id").cast(id_type).alias(id_col),
                      F.when(F.col("g") != "-", F.substring("g", 2, 1 << 30)).cast(group_type).alias(group_col),
                      "pos", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root",
                      (F.col("folded_root") == root).alias("verified"))


def op11_merkle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    shown = {"text": F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))}
    return merkle_manifest(docs, shown=shown).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


OP11_SQL = r"""
WITH RECURSIVE
crc AS (
  SELECT doc_id, xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT),
    lambda c, x: list_reduce(list_transform(range(8), lambda k: k::UBIGINT),
      lambda r, k: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::UBIGINT) ELSE r // 2 END, xor(c, x)),
    4294967295::UBIGINT), 4294967295::UBIGINT) % 2 = 0 AS even
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
shown AS (
  SELECT d.*, CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS other
  FROM documents d LEFT JOIN crc ON d.doc_id = crc.doc_id),
parts AS (
  SELECT doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS t, coalesce(strlen(other) || ':' || other, '-') AS o
  FROM shown),
hashed AS (SELECT doc_id, source, sha256(head || t) AS leaf, sha256(head || o) AS other FROM parts),
leaves AS (
  SELECT row_number() OVER () AS rid, *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, other) - 1 AS pos
  FROM hashed),
nodes AS (
  SELECT source, 0 AS level, pos, leaf AS digest FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY source) AS m FROM nodes) WHERE m > 1
  GROUP BY source, level, pos // 3),
subroots AS (
  SELECT source, max(level) AS height, arg_max(digest, level) AS subroot FROM nodes GROUP BY source),
ordered AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spos FROM subroots),
upper AS (
  SELECT 0 AS level, spos AS pos, subroot AS digest FROM ordered
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS m FROM upper) WHERE m > 1
  GROUP BY level, pos // 3),
top AS (SELECT max(level) AS height, arg_max(digest, level) AS root FROM upper),
steps AS (
  SELECT rid, n.level AS nr, l.pos // (3 ** n.level)::BIGINT AS own, n.pos, n.digest
  FROM leaves l JOIN ordered s ON l.source IS NOT DISTINCT FROM s.source
  JOIN nodes n ON n.source IS NOT DISTINCT FROM l.source AND n.level < s.height
    AND n.pos // 3 = l.pos // (3 ** (n.level + 1))::BIGINT
  UNION ALL
  SELECT rid, s.height + u.level, s.spos // (3 ** u.level)::BIGINT, u.pos, u.digest
  FROM leaves l JOIN ordered s ON l.source IS NOT DISTINCT FROM s.source, top
  JOIN upper u ON u.level < top.height AND u.pos // 3 = s.spos // (3 ** (u.level + 1))::BIGINT),
sides AS (
  SELECT rid, nr, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos < own), '') AS before,
         coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos > own), '') AS after
  FROM steps GROUP BY rid, nr),
paths AS (
  SELECT rid, sha256(string_agg(before || after, '' ORDER BY nr)) AS proof_sha256, list(before || '|' || after ORDER BY nr) AS path
  FROM sides GROUP BY rid),
folded AS (
  SELECT l.*, coalesce(proof_sha256, sha256('')) AS proof_sha256,
         CASE WHEN path IS NULL THEN other
              ELSE list_reduce(path, lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2)), other) END AS folded_root
  FROM leaves l LEFT JOIN paths USING (rid))
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM folded f JOIN ordered s ON f.source IS NOT DISTINCT FROM s.source, top
"""
