"""Operator 13, embedding near-dedup: an inverted multi-index, verified.

Two codebooks, one a half of the unit vectors, span a grid of cells.  A query
visits cells by rising distance (the sum of its halves' distances to the cell's
two centroids) until its partners are met with the target recall: how far that is
is measured at partners at exactly the threshold, the farthest there are.  Members
of the visited cells are verified in double precision.

Directions around which much of the table lies are kept out of the grid as balls:
vectors within half the threshold's angle of a pivot are linked to each other by
the triangle inequality, so a large group of near copies needs no pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, connected_components, map_arrow, skew_join, stage, text_slices
from .whitening import dimension, matrix, usable

#: Bound of the sample that codebooks, balls and the visited distance are fitted
#: on, in vectors and in numbers.
SAMPLE, SAMPLE_NUMBERS = 20_000, 1 << 22
#: Vectors a cell on average, and centroids of a codebook at most.
CELL, CENTROIDS = 64, 512
#: Share of the sample from which on a ball is worth its pivot (at most 1 / SHARE
#: pivots), and the least number of vectors.
SHARE, LEAST = 0.005, 20
#: Members and queries of a unit of work, and numbers that its members may hold.
UNIT, UNIT_NUMBERS = 16_384, 1 << 22
#: Angle that rounding can't reach.
SAFE = 1e-6
SALTS = 1 << 20


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision and without overflow."""
    x = x.astype(float)
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), np.finfo(float).tiny)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] + (centroids * centroids).sum(1) - 2 * x @ centroids.T


def codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centroids by Lloyd's rounds; an empty one takes the farthest vector."""
    centroids = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        far = distances(x, centroids)
        own = far.argmin(1)
        size = np.bincount(own, minlength=k)
        total = np.zeros_like(centroids)
        np.add.at(total, own, x)
        centroids = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centroids)
        for i in np.flatnonzero(size == 0):
            centroids[i] = x[far.min(1).argmax()]
    return centroids


@dataclass
class Index:
    """The fitted grid and balls; later the place of each cell's and ball's members."""
    threshold: float
    pivots: np.ndarray                      # p x d, unit rows
    first: np.ndarray                       # centroids of the halves
    second: np.ndarray
    slack: float                            # distance beyond the nearest cell's that is visited
    tile: np.ndarray | None = None          # first tile of each cell, then of each ball; -1 if empty
    parts: np.ndarray | None = None         # tiles that share its members
    salts: np.ndarray | None = None         # units that share a tile's queries, by tile

    @property
    def angle(self) -> float:
        return math.acos(self.threshold)

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.first.shape[1]
        return distances(x[:, :h], self.first), distances(x[:, h:], self.second)

    def balls(self, x: np.ndarray) -> np.ndarray:
        """Angles to the pivots."""
        return np.arccos(np.clip(x @ self.pivots.T, -1, 1))

    def place(self, x: np.ndarray) -> np.ndarray:
        """Each row's cell, or number of cells plus its ball."""
        a, b = self.halves(x)
        out = a.argmin(1) * len(self.second) + b.argmin(1)
        if len(self.pivots):
            far = self.balls(x)
            near = far.argmin(1)
            inside = far[np.arange(len(x)), near] <= self.angle / 2 - 2 * SAFE
            out = np.where(inside, self.cells + near, out)
        return out

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def visited(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Which of ``cells`` each row visits (rows x cells)."""
        a, b = self.halves(x)
        limit = a.min(1) + b.min(1) + self.slack
        return a[:, cells // len(self.second)] + b[:, cells % len(self.second)] <= limit[:, None]


def find_balls(x: np.ndarray, threshold: float) -> np.ndarray:
    """Pivots (means of dense neighbourhoods) whose balls hold at least SHARE of the
    sample each, without overlap."""
    angle = math.acos(threshold)
    least = max(LEAST, math.ceil(SHARE * len(x)))
    neighbours = np.concatenate([(x[i:i + 1000] @ x.T >= threshold).sum(1) for i in range(0, len(x), 1000)]) if len(x) else np.zeros(0)
    left = np.ones(len(x), bool)
    tried, pivots = neighbours < least, []
    while (open_ := np.flatnonzero(left & ~tried)).size:
        at = open_[neighbours[open_].argmax()]
        tried[at] = True
        mean = x[left & (x @ x[at] >= threshold)].mean(0)
        mean /= max(np.linalg.norm(mean), 1e-9)
        inside = left & (np.arccos(np.clip(x @ mean, -1, 1)) <= angle / 2 - 2 * SAFE)
        if inside.sum() >= least:
            pivots.append(mean)
            left &= ~inside
    return np.array(pivots).reshape(-1, x.shape[1])


def fit_index(sample: np.ndarray, n: int, threshold: float, recall: float, seed: int = 13) -> Index:
    """Index of ``n`` vectors, fitted on a sample of unit rows.

    ``recall`` is the share of partners at exactly the threshold (random
    directions) whose cell is visited; nearer partners are met more often.
    """
    rng = np.random.default_rng(seed)
    pivots = find_balls(sample[:4 * 1000], threshold)
    h = sample.shape[1] // 2
    empty = Index(threshold, pivots, np.zeros((1, h)), np.zeros((1, sample.shape[1] - h)), 0.0)
    rest = sample[empty.place(sample) < 1] if len(sample) else sample
    if len(rest) < 8:
        return empty
    k = int(np.clip(math.ceil(math.sqrt(n / CELL)), 1, min(CENTROIDS, len(rest) // 8)))
    index = Index(threshold, pivots, codebook(rest[:, :h], k, rng), codebook(rest[:, h:], k, rng), 0.0)
    own = rest[:4000]
    side = rng.standard_normal(own.shape)
    side -= (side * own).sum(1, keepdims=True) * own
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-9)
    partner = threshold * own + math.sqrt(1 - threshold ** 2) * side
    (a, b), (c, d) = index.halves(own), index.halves(partner)
    at = np.arange(len(own))
    beyond = a[at, c.argmin(1)] + b[at, d.argmin(1)] - a.min(1) - b.min(1)
    index.slack = float(np.quantile(beyond, recall)) + 1e-9
    return index


def lay_out(index: Index, counts: dict[int, int], sample: np.ndarray, n: int) -> None:
    """Deal cells and balls over tiles of about UNIT members (a larger one over
    several), and a tile's expected queries over units."""
    most = max(64, min(UNIT, UNIT_NUMBERS // sample.shape[1]))
    places = index.cells + len(index.pivots)
    index.tile, index.parts = np.full(places, -1), np.ones(places, np.int64)
    tiles, filled = 0, most + 1
    for at in sorted(counts):
        size = counts[at]
        if size > most or at >= index.cells:
            index.parts[at] = -(-size // most)
            tiles, filled = tiles + int(index.parts[at]), most + 1
            index.tile[at] = tiles - index.parts[at]
        else:
            if filled + size > most:
                tiles, filled = tiles + 1, 0
            index.tile[at] = tiles - 1
            filled += size
    index.salts = np.ones(max(1, tiles), np.int64)
    asked = np.zeros(max(1, tiles))
    own = sample[:2000]
    for tile in routes(index, own, index.place(own))[1]:
        asked[tile] += 1
    index.salts = np.maximum(1, np.ceil(asked / max(1, len(own)) * n / most)).astype(np.int64)


def routes(index: Index, x: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, tile) pairs that must be compared, and (row, ball) pairs whose members
    are all linked to the row by the triangle inequality."""
    rows, tiles = [], []
    cells = np.flatnonzero(index.tile[:index.cells] >= 0)
    free = np.flatnonzero(place < index.cells)
    group = index.tile[cells]
    order = np.argsort(group, kind="stable")
    cells, group = cells[order], group[order]
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)

    def add(row, at):                        # all tiles that share the members of a place
        n = index.parts[at]
        first = np.repeat(index.tile[at], n)
        rows.append(np.repeat(row, n))
        tiles.append(first + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))

    step = max(16, (1 << 24) // max(1, len(cells)))
    for i in range(0, len(free) if len(cells) else 0, step):
        part = free[i:i + step]
        seen = np.logical_or.reduceat(index.visited(x[part], cells), starts, axis=1)
        r, t = np.nonzero(seen)
        add(part[r], cells[starts[t]])
    sure = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    if len(index.pivots):
        far, half = index.balls(x), index.angle / 2
        after = (place < index.cells)[:, None] | (np.arange(len(index.pivots)) > (place - index.cells)[:, None])
        after &= index.tile[index.cells:] >= 0
        all_in = after & (far <= half)       # far + (half - 2 SAFE) is below the angle
        sure = np.nonzero(all_in)
        r, ball = np.nonzero(after & ~all_in & (far <= index.angle + half))
        add(r, index.cells + ball)
    return (*(np.concatenate(v) if v else np.zeros(0, np.int64) for v in (rows, tiles)), *sure)


class Unit:
    """The members of one unit of work; adds up links and keeps a forest of them."""

    def __init__(self, index: Index, table: pa.Table) -> None:
        self.index = index
        place = table["place"].to_numpy()
        order = np.argsort(place, kind="stable")
        self.place, self.c, self.w = place[order], table["c"].to_numpy()[order], table["w"].to_numpy()[order]
        self.x = unit_rows(matrix(table["v"].combine_chunks()))[order]
        self.cells, self.starts = np.unique(self.place, return_index=True)
        self.ends = np.append(self.starts[1:], len(self.place))
        self.links = np.zeros(len(self.c), np.int64)
        self.label = np.arange(len(self.c))

    def ask(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(kind, a, b) of a batch of queries: kind 0: node a has links of weight b;
        kind 1: a and b are connected."""
        x = unit_rows(matrix(batch.column("v")))
        c, w = batch.column("c").to_numpy(), batch.column("w").to_numpy()
        grid = self.cells[0] < self.index.cells          # tiles hold cells, or members of one ball
        seen = self.index.visited(x, self.cells) if grid else np.ones((len(x), 1), bool)
        found = np.zeros(len(x), np.int64)
        edges = []
        for nr, (start, end) in enumerate(zip(self.starts, self.ends)):
            asking = np.flatnonzero(seen[:, nr])
            step = max(1, (1 << 21) // (end - start))
            for i in range(0, len(asking), step):
                q = asking[i:i + step]
                hit = x[q] @ self.x[start:end].T >= self.index.threshold
                if grid:
                    hit &= c[q][:, None] < self.c[start:end]         # each pair from one side
                rows, cols = np.nonzero(hit)
                if not len(rows):
                    continue
                found += np.bincount(q[rows], weights=self.w[start + cols], minlength=len(x)).astype(np.int64)
                self.links += np.bincount(start + cols, weights=w[q[rows]], minlength=len(self.c)).astype(np.int64)
                edges.append(self._connect(c[q], rows, start + cols))
        some = np.flatnonzero(found)
        yield np.zeros(len(some), np.int32), c[some], found[some]
        for a, b in edges:
            yield np.ones(len(a), np.int32), a, b

    def _connect(self, query: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Connect each query with its members: one link a query to its smallest
        label, and links between the labels that meet, none twice."""
        labels = self.label[cols]
        low = np.full(len(query), len(self.c))
        np.minimum.at(low, rows, labels)
        own = np.flatnonzero(low < len(self.c))
        a, b = [query[own]], [self.c[low[own]]]
        pairs = np.unique(np.column_stack([labels, low[rows]])[labels != low[rows]], axis=0)
        if len(pairs):
            root: dict[int, int] = {}

            def top(i: int) -> int:
                while i in root:
                    i = root[i]
                return i

            for i, j in pairs.tolist():
                i, j = sorted((top(i), top(j)))
                if i != j:
                    root[j] = i
                    a.append(self.c[[i]])
                    b.append(self.c[[j]])
            to = np.arange(len(self.c))
            for j in root:
                to[j] = top(j)
            self.label = to[self.label]
        return np.concatenate(a), np.concatenate(b)

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        some = np.flatnonzero(self.links)
        return np.zeros(len(some), np.int32), self.c[some], self.links[some]


def _compare(asked: DataFrame, shared) -> DataFrame:
    """(kind, a, b) of all units; ``asked``: (unit, query, place, c, w, v)."""
    schema = "kind int, a long, b long"
    target = arrow_schema(asked.sparkSession, schema)

    def rows(parts):
        for part in parts:
            if len(part[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(part, target)], schema=target)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, unit = None, [], None
        for whole in batches:
            for batch in text_slices(whole):
                code = batch.column("unit").to_numpy() * 2 + batch.column("query").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), len(code)]
                for a, b in zip(cuts, cuts[1:]):
                    part, number = batch.slice(a, b - a), int(code[a]) // 2
                    if number != own:
                        if unit:
                            yield from rows([unit.counts()])
                        own, held, unit = number, [], None
                    if code[a] % 2 == 0:
                        held.append(part)
                    elif held or unit:
                        unit = unit or Unit(shared.value, pa.Table.from_batches(held))
                        held = []
                        yield from rows(unit.ask(part))
        if unit:
            yield from rows([unit.counts()])

    return asked.repartition("unit").sortWithinPartitions("unit", "query").mapInArrow(run, schema)


def class_links(classes: DataFrame, d: int, threshold: float, recall: float) -> DataFrame:
    """(c, links, node): for the vectors of ``classes`` (staged: c long, w long, v;
    v of ``d`` entries, not zero) the weight of other vectors linked, and a number
    that connected vectors share (their own c, or a negative one for a ball)."""
    spark = classes.sparkSession
    n = classes.count()
    bound = max(64, min(SAMPLE, SAMPLE_NUMBERS // d))
    picked = classes.orderBy(F.xxhash64("v"), "c").limit(bound).select("v").toArrow()       # bounded sample
    sample = unit_rows(matrix(picked["v"].combine_chunks())) if n else np.zeros((0, d))
    index = fit_index(sample, n, threshold, recall)
    fitted = spark.sparkContext.broadcast(index)

    def place(batch):
        return {x: batch[x] for x in ("c", "w", "v")} | {"place": fitted.value.place(unit_rows(matrix(batch["v"])))}

    kind = classes.schema["v"].dataType.simpleString()
    placed = stage(map_arrow(classes.select("c", "w", "v"), place, f"c long, w long, v {kind}, place long"))
    # One row a cell and ball: at most CENTROIDS^2 + 1 / SHARE numbers.
    counts = {r["place"]: r["n"] for r in placed.groupBy("place").agg(F.count("*").alias("n")).collect()}
    lay_out(index, counts, sample, n)
    laid = spark.sparkContext.broadcast(index)

    def deal(batch):
        index = laid.value
        at, c = batch["place"].to_numpy(), batch["c"].to_numpy()
        mix = (c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        own = index.tile[at] + (mix % index.parts[at].astype(np.uint64)).astype(np.int64)
        many = index.salts[own]
        member = np.repeat(np.arange(len(c)), many)
        salt = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        row, tile, sure, ball = routes(index, unit_rows(matrix(batch["v"])), at)
        asking = tile * SALTS + (mix[row] % index.salts[tile].astype(np.uint64)).astype(np.int64)
        take = np.concatenate([member, row, sure])
        unit = np.concatenate([own[member] * SALTS + salt, asking, -1 - ball])
        query = np.concatenate([np.zeros(len(member), np.int64), np.ones(len(row) + len(sure), np.int64)])
        v = batch["v"].take(pa.array(np.where(unit < 0, 0, take)))
        return {"unit": unit, "query": query, "place": at[take], "c": c[take], "w": batch["w"].to_numpy()[take], "v": v}

    dealt = stage(map_arrow(placed, deal, f"unit long, query long, place long, c long, w long, v {kind}"))
    found = stage(_compare(dealt.where("unit >= 0"), laid))
    cells = index.cells
    in_ball = placed.where(F.col("place") >= cells).select("c", "w", (F.lit(cells - 1) - F.col("place")).alias("ball"))
    sure = dealt.where("unit < 0").select("c", "w", F.col("unit").alias("ball"))
    size = in_ball.groupBy("ball").agg(F.sum("w").alias("size"))                            # at most 1 / SHARE rows
    linked = sure.groupBy("ball").agg(F.sum("w").alias("more"))
    sizes = F.broadcast(size.join(linked, "ball", "left"))
    links = (found.where("kind = 0").select(F.col("a").alias("c"), F.col("b").alias("links"))
             .unionByName(in_ball.join(sizes, "ball").select("c", (F.col("size") - F.col("w") + F.coalesce("more", F.lit(0))).alias("links")))
             .unionByName(sure.join(sizes, "ball").select("c", F.col("size").alias("links")))
             .groupBy("c").agg(F.sum("links").alias("links")))
    edges = (found.where("kind = 1").select("a", "b")
             .unionByName(in_ball.select(F.col("c").alias("a"), F.col("ball").alias("b")))
             .unionByName(sure.select(F.col("c").alias("a"), F.col("ball").alias("b"))))
    parts = connected_components(edges).where("node >= 0").select(F.col("node").alias("c"), "component")
    return (classes.select("c").join(links, "c", "left").join(parts, "c", "left")
            .select("c", F.coalesce("links", F.lit(0)).cast("long").alias("links"), F.coalesce("component", "c").alias("node")))


def embedding_dedup(df: DataFrame, threshold: float = 0.9, recall: float = 0.97, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per row of ``df``: ``id_col``, n_links (other rows linked to it
    directly), component_id (the smallest id that links reach, its own included)
    and kept (the id is component_id).

    Rows are linked when the cosine of their vectors, in double precision, is at
    least ``threshold`` (0 < threshold < 1).  Every link returned is verified (or
    proved by angles); at least about ``recall`` of all links are found, more of
    those well above the threshold, and all of those with a vector in a ball.
    Equal vectors are always linked and are compared as one.  Vectors that are null,
    empty, zero, or hold null or non-finite entries, and those of another length
    than most have, link with nothing.  Null ids count last: component_id is null
    only where no row of a component has an id, and kept then is true.  Rows that
    repeat an id each get their row (all kept, if one is).  An empty table gives an
    empty result; other columns aren't read.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    d = dimension(df, vec_col)
    ok = usable(F.col(vec_col)) & (F.size(vec_col) == max(1, d)) & F.exists(vec_col, lambda c: c != 0)
    rows = stage(df.select(F.col(id_col).alias("id"), F.when(ok, F.col(vec_col)).alias("v")).withColumn("_h", F.xxhash64("v")))
    used = rows.where("v is not null")
    # One row a vector: copies are combined in the map tasks.
    classes = stage(used.groupBy("_h", "v").agg(F.count("*").alias("w"), F.min("id").alias("low"))
                    .withColumn("c", F.monotonically_increasing_id()))
    found = class_links(classes.select("c", "w", "v"), max(1, d), threshold, recall)
    links = stage(classes.select("c", "_h", F.col("v").alias("_v"), "w", "low").join(found, "c"))
    lows = links.groupBy("node").agg(F.min("low").alias("component_id"))
    links = stage(links.join(lows, "node").select("_h", "_v", F.col("w").alias("_n"), (F.col("links") + F.col("w") - 1).alias("n_links"), "component_id"))
    alone = rows.where("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    joined = skew_join(used, links, "_h", "_n").where("v = _v").select("id", "n_links", "component_id")
    return (joined.unionByName(alone)
            .select(F.col("id").cast(id_type).alias(id_col), "n_links", F.col("component_id").cast(id_type).alias("component_id"),
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))


def op13_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return embedding_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
