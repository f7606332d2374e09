"""Exact user-user cosine similarity, by a co-rating join or by a grid.

Ratings enter as integers (millionths), so every dot product and norm is an exact
sum of integers: whatever the route, the partitioning and the order of the rows, a
similarity has the same bits, and so have the ranks that are taken from it.

* **Join**: the ratings joined with themselves on the movie, products summed by
  user pair with partial aggregation.  A movie with many raters is cut in
  chunks of raters and every two chunks are a join key of their own, so no task
  gets all pairs of a popular movie.  Its cost is the number of co-ratings, which
  on a sparse catalogue grows in proportion to the ratings.
* **Grid**: on a dense catalogue (few movies, many raters each) the co-ratings
  are far more than the ratings.  There users are hashed into blocks, a block's ratings
  are packed in a few bytes each, and each block meets all blocks one after the
  other in one task, which sums the products with numpy tile by tile, so that
  co-ratings never become Spark rows.  For a top-k a task holds the k best of its
  users so far, and of a tile only pairs that can still be among them leave the matrix.

The counted cost of both decides (one aggregate over the ratings); a block
also has bounds on its rows and on one user's ratings, beyond which the join
is taken.  Ratings are positive, so missing pairs have similarity 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import reliable_checkpoint, top_n_per_group
from ..session import ship_package
from .pairs import RUN_SCHEMA, pack_runs

SIM_SCHEMA = "user_id long, neighbor_id long, similarity double"

SCALE = 1_000_000               # ratings are compared in millionths
CHUNK_RATERS = 1024             # raters of a movie that meet others in one join key
PAIR_CHUNK = 1 << 21            # co-rating products a grid cell expands at a time
DENSE_CELL = 1 << 23            # user pairs of a cell whose sums are one array (64 MB)
DENSE_MATRIX = 1 << 22          # entries of a cell's users x movies matrix (32 MB)
DENSE_FLOPS = 200               # matrix products worth one expanded co-rating
TILE_ROWS, TILE_COLUMNS = 64, 4096    # user pairs whose dot products are one matrix (2 MB at most)
NEAR_ROWS, NEAR_COLUMNS = 256, 1024   # the same for a top-k, which keeps the left users' matrix
TILE_CHUNK = 32                 # least users of a tile's side, whatever the number of movies
BLOCK_USERS = 16384             # target users per grid block
TASK_USERS = 256                # least users worth a task of their own
CELL_ROWS = 2_000_000           # most rating rows that two grid blocks may be planned to hold
USER_ROWS = 200_000             # most ratings of one user the grid takes
# Costs of the grid in pairs that the join makes (about 40 bytes each): a packed
# rating that is copied, and a user pair that is looked at.
COPY_COST, CELL_COST = 1 / 5, 1 / 1000
TASK_PAIRS = 4_000_000          # pairs that a task sums and compares with floors
PASS_PAIRS = 1 << 29            # ordered pairs that a top-k on the join route moves at a time
HEAD = 4                        # raters of a movie that the floors of a top-k are taken from


def scaled(rating: Column) -> Column:
    """A rating in whole millionths."""
    return F.round(rating.cast("double") * SCALE).cast("bigint")


def _block_dot(lu, lm, lq, nl, ru, rm, rq, nr):
    """Non-zero dot products between left users (local ids below ``nl``) and
    right users (below ``nr``) of sparse integer vectors given as (user, movie,
    value) triples: (left_idx, right_idx, dot).

    Values are divided by their common divisor first; while no sum can reach 2^53
    doubles add them exactly, in a matrix product where most movies are rated
    by most users and in one array of products by pair elsewhere.  Larger values are
    added as integers.  Any way gives the exact sums.
    """
    if not len(lq) or not len(rq):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    unit = max(1, int(np.gcd.reduce(np.concatenate([lq, rq]))))
    lq, rq = lq // unit, rq // unit
    longest = min(np.bincount(lu).max(), np.bincount(ru).max())
    exact = float(np.abs(lq).max()) * float(np.abs(rq).max()) * float(longest) < 2 ** 53
    movies, code = np.unique(np.concatenate([lm, rm]), return_inverse=True)
    lc, rc, nm = code[:len(lm)], code[len(lm):], len(movies)
    pairs = float(np.bincount(lc, minlength=nm).astype(float) @ np.bincount(rc, minlength=nm))
    if exact and max(nl, nr) * nm <= DENSE_MATRIX and nl * nr <= DENSE_CELL and float(nl) * nr * nm <= DENSE_FLOPS * pairs:
        left, right = np.zeros((nl, nm)), np.zeros((nr, nm))
        left[lu, lc], right[ru, rc] = lq, rq
        dots = left @ right.T
        li, ri = np.nonzero(dots)
        return li, ri, dots[li, ri].astype(np.int64) * (unit * unit)
    order = np.argsort(rc, kind="stable")
    rc, ru, rq = rc[order], ru[order], rq[order]
    lo = np.searchsorted(rc, lc, "left")
    cnt = np.searchsorted(rc, lc, "right") - lo
    ends = np.cumsum(cnt)
    whole = nl * nr <= DENSE_CELL                 # one sum a pair of users fits in an array
    total = np.zeros(nl * nr if whole else 0, float if exact else np.int64)
    keys, dots, start = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    while start < len(cnt):
        base = ends[start - 1] if start else 0
        end = max(int(np.searchsorted(ends, base + PAIR_CHUNK, "right")), start + 1)
        c = cnt[start:end]
        owner = np.repeat(np.arange(start, end), c)
        at = np.arange(int(c.sum())) + np.repeat(lo[start:end] - (np.cumsum(c) - c), c)
        key, product = lu[owner].astype(np.int64) * nr + ru[at], lq[owner] * rq[at]
        if whole and exact:
            total += np.bincount(key, weights=product, minlength=len(total))
        elif whole:
            np.add.at(total, key, product)
        elif len(key):                                   # integer sums: the order doesn't matter
            keys, dots = np.concatenate([keys, key]), np.concatenate([dots, product])
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, dots = keys[first], np.add.reduceat(dots[order], first)
        start = end
    if whole:
        keys = np.flatnonzero(total)
        dots = total[keys].astype(np.int64)
    return keys // nr, keys % nr, dots * (unit * unit)


def _top_k_local(u, v, s, k):
    """Per ``u`` keep the ``k`` best (similarity desc, neighbour id asc)."""
    if k is None or len(u) == 0:
        return u, v, s
    order = np.lexsort((v, -s, u))
    u, v, s = u[order], v[order], s[order]
    starts = np.r_[0, np.flatnonzero(u[1:] != u[:-1]) + 1]
    group_start = np.repeat(starts, np.diff(np.r_[starts, len(u)]))
    keep = (np.arange(len(u)) - group_start) < k
    return u[keep], v[keep], s[keep]


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold them all, after the kind."""
    low, high = (int(values.min()), int(values.max())) if len(values) else (0, 0)
    kind = next(k for k in "BHihq" if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return kind.encode() + values.astype(kind).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, data[:1].decode(), offset=1).astype(np.int64)


def _pack_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row for a block: its users' whole vectors, by user and movie."""
    users, movies, q = (pdf[c].to_numpy(np.int64) for c in ("user_id", "movie_id", "_q"))
    order = np.lexsort((movies, users))
    users, movies, q = users[order], movies[order], q[order]
    ids, first, sizes = np.unique(users, return_index=True, return_counts=True)
    floors = pdf["_f"].to_numpy(np.float64)[order][first]
    return pd.DataFrame({"_b": pdf["_b"].iloc[:1].to_numpy(np.int32), "users": [_pack(ids)], "sizes": [_pack(sizes)], "movies": [_pack(movies)],
                         "q": [_pack(q)], "floors": [floors.tobytes() if floors.any() else b""]})


class _Block:
    """A block's vectors, unpacked."""

    def __init__(self, number: int, users: bytes, sizes: bytes, movies: bytes, q: bytes, floors: bytes):
        self.number, self.users, self.sizes, self.movies, self.q = number, _unpack(users), _unpack(sizes), _unpack(movies), _unpack(q)
        self.n = len(self.users)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.of = np.repeat(np.arange(self.n), self.sizes)
        self.squares = np.add.reduceat(self.q * self.q, self.starts[:-1])
        self.norms = np.sqrt(self.squares.astype(np.float64))
        self.unit = max(1, int(np.gcd.reduce(self.q)))
        self.largest = int(np.abs(self.q).max()) // self.unit
        self.floor = np.frombuffer(floors).copy() if floors else np.full(self.n, -np.inf)
        self.columns, self.code = np.unique(self.movies, return_inverse=True)
        self.counts = np.bincount(self.code)

    def codes_in(self, other: "_Block") -> np.ndarray:
        """Per rating the column of its movie in ``other``, or -1."""
        at = np.minimum(np.searchsorted(other.columns, self.movies), len(other.columns) - 1)
        return np.where(other.columns[at] == self.movies, at, -1)

    def matrix(self, lo: int, hi: int, code: np.ndarray, columns: int, kind, of: int = 1) -> np.ndarray:
        """Ratings in units of users ``lo`` to ``hi`` as a dense matrix, with empty
        rows up to a multiple of ``of``."""
        out = np.zeros((-(-(hi - lo) // of) * of, columns), kind)
        part = slice(self.starts[lo], self.starts[hi])
        seen = code[part] >= 0
        out[(self.of[part] - lo)[seen], code[part][seen]] = (self.q[part] // self.unit)[seen]
        return out


def _dense(a: _Block, b: _Block, code: np.ndarray) -> bool | None:
    """Whether two blocks (``code``: the columns in ``a`` of b's ratings) are multiplied
    as matrices, which adds exactly; None if no movie is in both."""
    n = len(a.columns)
    pairs = float(a.counts.astype(float) @ np.bincount(code[code >= 0], minlength=n))
    if not pairs:
        return None
    return min(a.q.min(), b.q.min()) >= 0 and _most(a, b) < 2 ** 53 and n <= DENSE_MATRIX // TILE_CHUNK and float(a.n) * b.n * n <= DENSE_FLOPS * pairs


def _most(a: _Block, b: _Block) -> float:
    """No sum of two users' products, in the blocks' units, is larger."""
    return float(a.largest) * float(b.largest) * float(min(a.sizes.max(), b.sizes.max()))


def _sparse_tiles(a: _Block, b: _Block):
    """(left_idx, right_idx, dot) of two blocks whose movies are sparse; bounded parts,
    whatever the size of the blocks."""
    step = max(1, DENSE_CELL // b.n)
    for lo in range(0, a.n, step):
        hi = min(a.n, lo + step)
        part = slice(a.starts[lo], a.starts[hi])
        li, ri, dot = _block_dot(a.of[part] - lo, a.movies[part], a.q[part], hi - lo, b.of, b.movies, b.q, b.n)
        yield li + lo, ri, dot


def _all_tiles(a: _Block, b: _Block, code: np.ndarray, floor: np.ndarray):
    """(left_idx, right_idx, dot) of the pairs of two dense blocks that may reach the
    left user's ``floor``: every dot product, tile by tile."""
    n = len(a.columns)
    kind = np.float32 if _most(a, b) < 2 ** 24 else np.float64          # sums below are exact
    wide = max(TILE_CHUNK, min(TILE_COLUMNS, DENSE_MATRIX // n))
    for at in range(0, b.n, wide):
        cols = slice(at, min(b.n, at + wide))
        right = b.matrix(at, cols.stop, code, n, kind).T
        scale = (a.unit * b.unit / np.maximum(b.norms[cols], 1e-300)).astype(kind)
        for lo in range(0, a.n, TILE_ROWS):
            rows = slice(lo, min(a.n, lo + TILE_ROWS))
            dots = a.matrix(lo, rows.stop, a.code, n, kind) @ right
            # Dot products over the right norm: a row's own norm doesn't change its order.
            least = (floor[rows] * a.norms[rows] * (1 - 2.0 ** -20)).astype(kind)                       # roundings lose far less
            li, ri = np.nonzero(dots * scale >= np.maximum(least, np.finfo(kind).tiny)[:, None])
            yield li + lo, ri + at, dots[li, ri].astype(np.int64) * (a.unit * b.unit)


def _near_tiles(a: _Block, b: _Block, code: np.ndarray, same: bool, floor: np.ndarray, k: int):
    """(left_idx, right_idx, dot) of the pairs of two dense blocks that may reach the
    left user's ``floor`` and be among its ``k`` best.

    Normalised right vectors are multiplied in one matrix a tile, and a bound on what
    roundings lose tells the pairs that may count.  These are then multiplied exactly.
    ``floor`` may rise meanwhile."""
    n = len(a.columns)
    kind = np.float32 if max(a.largest, b.largest) < 2 ** 24 else np.float64         # ratings are exact, their sums needn't be
    loss = (2 * n + 16) * 2.0 ** -24              # of a sum of n positive products, at most
    strip, wide = (max(TILE_CHUNK, min(most, DENSE_MATRIX // n)) for most in (a.n, NEAR_COLUMNS))
    for top in range(0, a.n, strip):
        end = min(a.n, top + strip)
        left = a.matrix(top, end, a.code, n, kind)
        for at in range(0, b.n, wide):
            cols = slice(at, min(b.n, at + wide))
            right = b.matrix(at, cols.stop, code, n, kind, 8)
            scale = np.zeros(len(right))
            scale[:cols.stop - at] = b.unit / np.maximum(b.norms[cols], 1e-300)
            normed = (right * scale[:, None]).astype(kind).T
            for lo in range(top, end, NEAR_ROWS):
                rows = slice(lo, min(end, lo + NEAR_ROWS))
                mine = left[lo - top:rows.stop - top]
                near = mine @ normed
                if same and rows.start < cols.stop and cols.start < rows.stop:
                    both = np.arange(max(rows.start, cols.start), min(rows.stop, cols.stop))
                    near[both - rows.start, both - cols.start] = 0
                least = floor[rows] * a.norms[rows] / a.unit * (1 - loss)
                open_ = np.flatnonzero(floor[rows] <= 0)
                if len(open_) and k <= near.shape[1]:
                    kth = np.partition(near[open_], near.shape[1] - k, axis=1)[:, near.shape[1] - k]
                    least[open_] = np.maximum(least[open_], kth * (1 - 2 * loss))
                may = near >= np.maximum(least * (1 - 2.0 ** -22), np.finfo(kind).tiny).astype(kind)[:, None]
                eight = np.flatnonzero(may.view(np.uint64))                 # few are true: eight are tested at once
                bit = np.flatnonzero(may.reshape(-1, 8)[eight])
                hit = eight[bit // 8] * 8 + bit % 8
                li, ri = np.divmod(hit, near.shape[1])
                if len(hit) * n <= DENSE_MATRIX:
                    dot = np.einsum("ij,ij->i", mine[li].astype(np.float64), right[ri].astype(np.float64))
                else:
                    dot = (mine.astype(np.float64) @ right.T.astype(np.float64))[li, ri]
                yield li + lo, ri + at, dot.astype(np.int64) * (a.unit * b.unit)


def _similarities(a: _Block, b: _Block, same: bool, floor: np.ndarray, k: int | None):
    """(left_idx, right_idx, similarity) of the pairs of two blocks that reach the left
    user's ``floor``, tile by tile; with ``k`` those of a tile that can't be among a user's k
    best may be left out.  ``same``: the blocks are one, and self pairs are left out."""
    code = b.codes_in(a)
    dense = _dense(a, b, code)
    if dense is None:
        return
    tiles = _sparse_tiles(a, b) if not dense else _all_tiles(a, b, code, floor) if k is None else _near_tiles(a, b, code, same, floor, k)
    for li, ri, dot in tiles:
        # Same operation order as on the join route and in the SQL definition.
        sim = dot / (a.norms[li] * b.norms[ri])
        keep = sim >= floor[li]
        if same:
            keep &= li != ri
        yield li[keep], ri[keep], sim[keep]


def _grid_kernel(symmetric: bool, top_k: int | None):
    """Kernel for a partition of blocks (left one first, then all it meets): one
    right block is held at a time, and with ``top_k`` the best pairs so far."""
    kind = pa.schema([("user_id", pa.int64()), ("neighbor_id", pa.int64()), ("similarity", pa.float64())])

    def rows(u, v, s):
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(s)], schema=kind)

    def run(batches):
        left, floor, best = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                task, side, number, *packed = (c[i].as_py() for c in batch.columns)
                if side == 0:
                    if best is not None:
                        yield rows(left.users[best[0]], *best[1:])
                    left = _Block(number, *packed)
                    floor, best = left.floor, None
                    continue
                if left is None or left.number != task:
                    continue                                  # no user has this left block's number
                right = _Block(number, *packed)
                found = _similarities(left, right, symmetric and left.number == number, floor, top_k)
                if top_k is None:
                    for li, ri, sim in found:
                        yield rows(left.users[li], right.users[ri], sim)
                    continue
                more, new = [best] if best is not None else [], 0
                for li, ri, sim in found:
                    more.append((li, right.users[ri], sim))
                    new += len(li)
                    if new > top_k * left.n + PAIR_CHUNK // 64:            # a user's floor rises once it has k pairs
                        more, new = [_cut(more, floor, top_k)], 0
                if more:
                    best = _cut(more, floor, top_k)
        if best is not None:
            yield rows(left.users[best[0]], *best[1:])
    return run


def _packed_kernel():
    """Kernel for a partition of blocks like :func:`_grid_kernel`'s, whose pairs stay packed in runs
    (:mod:`.pairs`); two blocks meet in one of their tasks."""
    def run(batches):
        left = None
        for batch in batches:
            for i in range(batch.num_rows):
                task, side, number, *packed = (c[i].as_py() for c in batch.columns)
                if side == 0:
                    left = _Block(number, *packed)
                    continue
                if left is None or left.number != task:
                    continue
                right = _Block(number, *packed)
                code = right.codes_in(left)
                dense = _dense(left, right, code)
                if dense is None:
                    continue
                same, unit = left.number == number, left.unit * right.unit
                for li, ri, dot in _all_tiles(left, right, code, left.floor) if dense else _sparse_tiles(left, right):
                    if same:
                        li, ri, dot = (x[li != ri] for x in (li, ri, dot))
                    if len(li):
                        yield pack_runs(left.users, left.squares, right.users, right.squares, li, ri, dot, unit, not same)
    return run


def _cut(parts, floor: np.ndarray, k: int):
    """The ``k`` best pairs of each left user in ``parts``; raises the floors of users that have k."""
    u, v, s = _top_k_local(*(np.concatenate(x) for x in zip(*parts)), k)
    full = np.bincount(u, minlength=len(floor)) == k
    last = np.flatnonzero(np.r_[u[1:] != u[:-1], True]) if len(u) else np.zeros(0, np.int64)
    last = last[full[u[last]]]
    floor[u[last]] = np.maximum(floor[u[last]], s[last])
    return u, v, s


@dataclass
class Layout:
    """How a product is computed: ``join``, or a grid of left x right blocks;
    with ``floors`` a top-k drops pairs below a user's floor before they are ranked."""
    join: bool
    left_blocks: int = 1
    right_blocks: int = 1
    floors: bool = False
    pairs: float = 0.0              # co-ratings counted when it was planned (a symmetric pair once)


def plan_layout(spark, left: DataFrame, right: DataFrame | None) -> Layout:
    """The cheaper route by counted cost (one aggregate a movie and one a user)."""
    symmetric = right is None
    sides = left.select("user_id", "movie_id", F.lit(0).alias("_s"))
    if not symmetric:
        sides = sides.unionByName(right.select("user_id", "movie_id", F.lit(1).alias("_s")))
    on_left, on_right = F.count_if(F.col("_s") == 0), F.count_if(F.col("_s") == 1)
    co = sides.groupBy("movie_id").agg(on_left.cast("double").alias("l"), on_right.cast("double").alias("r"))
    pairs = co.agg(F.sum(F.col("l") * (F.col("l") / 2 if symmetric else F.col("r")))).first()[0] or 0.0
    per_user = sides.groupBy("_s", "user_id").agg(F.count("*").alias("n"))
    count = {r["_s"]: r for r in per_user.groupBy("_s").agg(
        F.count("*").alias("users"), F.sum("n").alias("rows"), F.max("n").alias("longest")).collect()}   # <= 2 rows
    if len(count) < (1 if symmetric else 2):
        return Layout(True, pairs=pairs)
    cores = spark.sparkContext.defaultParallelism
    blocks = [max(-(-c["users"] // BLOCK_USERS), -(-2 * c["rows"] // CELL_ROWS)) for _, c in sorted(count.items())]
    # A left block is a task: some for every core, where there are users enough.
    blocks[0] = max(blocks[0], min(4 * cores, -(-count[0]["users"] // TASK_USERS)))
    if symmetric:
        blocks = [blocks[0]] * 2
    right_side = count[0 if symmetric else 1]
    packed = sum(c["rows"] for c in count.values())
    cost = packed + COPY_COST * right_side["rows"] * blocks[0] + CELL_COST * count[0]["users"] * right_side["users"]
    longest = max(c["longest"] for c in count.values())
    return Layout(longest > USER_ROWS or cost > pairs, *blocks, pairs=pairs)


def _with_norms(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with its user's squared norm as ``name``."""
    return rows.join(rows.groupBy("user_id").agg(F.sum(F.col("_q") * F.col("_q")).alias(name)), "user_id")


def _heads(normed: DataFrame, head: int | None = None) -> DataFrame:
    """Each movie's raters of the largest normalised rating (``head``, or HEAD)."""
    weight = F.col("_q") / F.sqrt("_n")
    heads = top_n_per_group(normed, ["movie_id"], [weight.desc(), F.col("user_id").asc()], head or HEAD)
    return heads.select("movie_id", F.col("user_id").alias("_v"), F.col("_q").alias("_qv"), F.col("_n").alias("_nv"))


def similarity_floors(rows: DataFrame, k: int, head: int | None = None) -> DataFrame:
    """(user_id, floor): for each user with at least ``k`` partners among them, a
    lower bound of its k-th best similarity.

    An impact-ordered inverted index: each movie's postings are cut to the ``head``
    raters of the largest normalised rating.  Products with these alone make partial dot
    products, and a partial one is never over the whole (ratings are positive),
    in doubles too, as the same division follows.  ``rows``: user_id, movie_id, _q.
    """
    normed = _with_norms(rows, "_n")
    return _floors(normed, _heads(normed, head), k)


def _floors(normed: DataFrame, heads: DataFrame, k: int) -> DataFrame:
    """:func:`similarity_floors` of some users' ratings, from all movies' heads."""
    met = normed.join(heads, "movie_id").where("user_id <> _v").select("user_id", "_v", (F.col("_q") * F.col("_qv")).alias("_p"), "_n", "_nv")
    # Dealt by user, products are summed and ranked where they are.
    partial = (met.repartition("user_id").groupBy("user_id", "_v").agg(F.sum("_p").alias("_dot"), F.max("_n").alias("_n"), F.max("_nv").alias("_nv"))
               .select("user_id", "_v", (F.col("_dot").cast("double") / (F.sqrt("_n") * F.sqrt("_nv"))).alias("floor")))
    return (top_n_per_group(partial, ["user_id"], [F.col("floor").desc(), F.col("_v").asc()], k)
            .where(F.col("rank") == k).select("user_id", "floor"))


def _joined(left: DataFrame, right: DataFrame | None, floors: DataFrame | None = None, n_pairs: float = 0.0, part_of: DataFrame | None = None) -> DataFrame:
    """The join route: all positive pairs, for a symmetric product both ways; with
    ``floors`` (see :func:`similarity_floors`) those that reach their user's floor.
    ``part_of``: the product of some users' ratings with all users' (both with norms ``_n``).

    With floors or a part the pairs (about ``n_pairs``, each once) are dealt by user, both ways, so that
    they are summed, compared with the floor and ranked later without being moved again."""
    symmetric = right is None
    dealt = floors is not None or part_of is not None

    def side(rows: DataFrame, name: str) -> DataFrame:
        normed = rows.withColumnRenamed("_n", f"_n{name}") if part_of is not None else _with_norms(rows, f"_n{name}")
        return normed.select(F.col("user_id").alias(f"_u{name}"), "movie_id", F.col("_q").alias(f"_q{name}"), f"_n{name}")

    a = side(left, "a")
    b = side(part_of if part_of is not None else left if symmetric else right, "b")
    # Chunks of each movie's raters; all but popular movies have one.
    every = left if part_of is None else part_of
    raters = every.select("movie_id").unionByName((every if symmetric else right).select("movie_id")) \
        .groupBy("movie_id").agg(F.ceil(F.count("*") / (2 * CHUNK_RATERS)).cast("int").alias("_c"))
    chunk = lambda u: F.pmod(F.xxhash64(u), F.col("_c"))
    others = F.explode(F.sequence(F.lit(0), F.col("_c") - 1))
    popular = raters.where("_c > 1")

    def pairs(x: DataFrame, y: DataFrame, keys: list[str]) -> DataFrame:
        met = x.join(y, keys)
        return (met.where("_ua <> _ub" if dealt else "_ua < _ub") if symmetric else met).select("_ua", "_ub", (F.col("_qa") * F.col("_qb")).alias("_p"), "_na", "_nb")

    wide_a, wide_b = a.join(popular, "movie_id", "left"), b.join(popular, "movie_id", "left")
    wide_a, wide_b = (x.withColumn("_c", F.coalesce("_c", F.lit(1))) for x in (wide_a, wide_b))
    met = pairs(wide_a.select("*", chunk("_ua").alias("_i"), others.alias("_j")).drop("_c"),
                wide_b.select("*", chunk("_ub").alias("_j"), others.alias("_i")).drop("_c"), ["movie_id", "_i", "_j"])
    if dealt:
        parts = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(2 * n_pairs / TASK_PAIRS))
        sums = (met.select("_ua", "_ub", "_p", "_nb").repartition(parts, "_ua").groupBy("_ua", "_ub")
                .agg(F.sum("_p").alias("_dot"), F.max("_nb").alias("_nb")))
        own = a.groupBy("_ua").agg(F.max("_na").alias("_na"))
        own = own.withColumn("floor", F.lit(0.0)) if floors is None else own.join(floors.withColumnRenamed("user_id", "_ua"), "_ua", "left")
        # the larger side stays where it was dealt
        sim = F.col("_dot").cast("double") / (F.sqrt("_na") * F.sqrt("_nb"))
        return (sums.join(own.repartition(parts, "_ua"), "_ua").select(F.col("_ua").alias("user_id"), F.col("_ub").alias("neighbor_id"), sim.alias("similarity"), "floor")
                .where(F.col("similarity") >= F.coalesce("floor", F.lit(0.0))).drop("floor"))
    if symmetric:
        # Few pairs come twice in a task: they are moved as they are, not collected before in tables that spill.
        parts = math.ceil(n_pairs / TASK_PAIRS)
        keys = [F.col("_ua"), F.col("_ub")]
        met = met.repartition(parts, *keys) if parts > int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")) else met.repartition(*keys)
    sims = (met.groupBy("_ua", "_ub").agg(F.sum("_p").alias("_dot"), F.max("_na").alias("_na"), F.max("_nb").alias("_nb"))
            .select(F.col("_ua").alias("user_id"), F.col("_ub").alias("neighbor_id"),
                    (F.col("_dot").cast("double") / (F.sqrt("_na") * F.sqrt("_nb"))).alias("similarity")))
    if symmetric:
        both = F.explode(F.array(F.struct("user_id", "neighbor_id"),
                                 F.struct(F.col("neighbor_id").alias("user_id"), F.col("user_id").alias("neighbor_id")))).alias("_p")
        sims = sims.select(both, "similarity").select("_p.user_id", "_p.neighbor_id", "similarity")
    return sims


def _passes(pairs: float) -> int:
    """In how many parts of the users a top-k on the join route is computed."""
    return max(1, math.ceil(2 * pairs / PASS_PAIRS))


def _joined_in_parts(rows: DataFrame, floor_of: int | None, pairs: float, finish) -> DataFrame:
    """The join route for a hash part of the users at a time, each against all: what is
    moved at once is bounded, as a part's shuffle files are gone before the next.
    ``floor_of``: pairs have to reach the floors of a top-``floor_of``; ``finish``: what is
    stored of a part's pairs."""
    n = _passes(pairs)
    rows = reliable_checkpoint(_with_norms(rows, "_n"))
    heads = None if floor_of is None else reliable_checkpoint(_heads(rows))
    found = None
    for i in range(n):
        some = rows.where(F.pmod(F.xxhash64("user_id", F.lit(n)), F.lit(n)) == i)
        floors = None if heads is None else _floors(some, heads, floor_of)
        part = reliable_checkpoint(finish(_joined(some, None, floors, pairs / n, part_of=rows)))
        found = part if found is None else found.unionByName(part)
    return found


def _gridded(left: DataFrame, right: DataFrame | None, layout: Layout, top_k: int | None, floors: DataFrame | None = None) -> DataFrame:
    """The grid route: every left block is a task that meets all right blocks, of
    which each task gets a packed copy.  ``floors``: see :func:`similarity_floors`."""
    ship_package(left.sparkSession)          # the kernel runs in the Python workers
    symmetric = right is None

    def packed(rows: DataFrame, n: int) -> DataFrame:
        rows = rows.withColumn("_f", F.lit(0.0)) if floors is None else \
            rows.join(floors, "user_id", "left").withColumn("_f", F.coalesce("floor", F.lit(0.0))).drop("floor")
        return (rows.select(F.pmod(F.xxhash64("user_id"), F.lit(n)).cast("int").alias("_b"), "user_id", "movie_id", "_q", "_f")
                .groupBy("_b").applyInPandas(_pack_block, "_b int, users binary, sizes binary, movies binary, q binary, floors binary"))

    every = F.sequence(F.lit(0), F.lit(layout.left_blocks - 1))
    ahead = lambda t: F.pmod(F.col("_b") - t, F.lit(layout.left_blocks))
    # Of two blocks' tasks the one from which the other block is nearer, counted upwards.
    once = F.filter(every, lambda t: (2 * ahead(t) < layout.left_blocks) | ((2 * ahead(t) == layout.left_blocks) & (t < F.col("_b"))))

    def dealt(blocks: DataFrame, *sides: int, tasks: Column = every) -> DataFrame:
        roles = {0: F.array(F.struct(F.col("_b").alias("_t"), F.lit(0).alias("_side"))),
                 1: F.transform(tasks, lambda t: F.struct(t.alias("_t"), F.lit(1).alias("_side")))}
        return blocks.withColumn("_r", F.explode(F.concat(*[roles[s] for s in sides]))).select(
            "_r._t", "_r._side", "_b", "users", "sizes", "movies", "q", "floors")

    blocks = packed(left, layout.left_blocks)
    def tasks(met: DataFrame) -> DataFrame:
        return met.repartitionById(layout.left_blocks, F.col("_t")).sortWithinPartitions("_t", "_side", "_b")

    met = dealt(blocks, 0, 1) if symmetric else dealt(blocks, 0).unionByName(dealt(packed(right, layout.right_blocks), 1))
    sims = tasks(met).mapInArrow(_grid_kernel(symmetric, top_k), SIM_SCHEMA)
    if symmetric and top_k is None and floors is None:
        sims.packed_runs = tasks(dealt(blocks, 0, 1, tasks=once)).mapInArrow(_packed_kernel(), RUN_SCHEMA)
    return sims


def cosine_similarity(cells: DataFrame, right: DataFrame | None = None, *,
                      top_k: int | None = None, layout: Layout | None = None) -> DataFrame:
    """Cosine similarity between users' rating vectors.

    ``cells``: (user_id, movie_id, rating) with one row per (user, movie) and
    positive ratings.  Without ``right`` this is the self-similarity of all
    users (self pairs excluded, both directions emitted); with ``right`` it is
    the bipartite similarity of ``cells`` users (``user_id``) against
    ``right`` users (``neighbor_id``).

    Returns (user_id, neighbor_id, similarity) for pairs with similarity > 0,
    or - with ``top_k`` - each user's ``top_k`` best by (similarity desc,
    neighbor_id asc) with their ``rank``.  On the grid route, all pairs of
    ``cells`` also come packed, as the attribute ``packed_runs``.  ``layout`` forces a route (the result
    is the same to the bit on every one).
    """
    lt = cells.select("user_id", "movie_id", scaled(F.col("rating")).alias("_q"))
    rt = None if right is None else right.select("user_id", "movie_id", scaled(F.col("rating")).alias("_q"))
    layout = layout or plan_layout(cells.sparkSession, lt, rt)
    with_floors = layout.floors and rt is None and top_k is not None
    if layout.join and rt is None and top_k is not None and _passes(layout.pairs) > 1:
        return _joined_in_parts(lt, top_k if with_floors else None, layout.pairs, lambda sims: _ranked(sims, top_k))
    floors = similarity_floors(lt, top_k) if with_floors else None
    sims = _joined(lt, rt, floors, layout.pairs) if layout.join else _gridded(lt, rt, layout, top_k, floors)
    if top_k is not None:
        # One ranked window merges what cells or partial sums have left of a user.
        sims = _ranked(sims, top_k)
    return sims


def _ranked(sims: DataFrame, k: int) -> DataFrame:
    return top_n_per_group(sims, ["user_id"], [F.col("similarity").desc(), F.col("neighbor_id").asc()], k)


def candidate_pairs(cells: DataFrame, k: int, layout: Layout | None = None) -> DataFrame:
    """What a top-``k`` with floors passes on: (user_id, neighbor_id, similarity) of
    the pairs that reach the user's floor, before any is ranked."""
    rows = cells.select("user_id", "movie_id", scaled(F.col("rating")).alias("_q"))
    layout = layout or plan_layout(cells.sparkSession, rows, None)
    if layout.join and _passes(layout.pairs) > 1:
        return _joined_in_parts(rows, k, layout.pairs, lambda sims: sims)
    floors = similarity_floors(rows, k)
    return _joined(rows, None, floors, layout.pairs) if layout.join else _gridded(rows, None, layout, None, floors)


def similarity_with_self(cells: DataFrame) -> DataFrame:
    """the similarity table with the diagonal kept (self = 1.0)."""
    sims = cosine_similarity(cells)
    selfs = cells.select("user_id").distinct().select(
        "user_id", F.col("user_id").alias("neighbor_id"), F.lit(1.0).alias("similarity"))
    return sims.unionByName(selfs)


def top_neighbors(cells: DataFrame, k: int, sims: DataFrame | None = None) -> DataFrame:
    """F7 for every user: (user_id, neighbor_id, similarity, rank) with
    rank 1..k by (similarity desc, neighbor_id asc), positive similarity only."""
    if sims is None:
        return cosine_similarity(cells, top_k=k)
    return _ranked(sims, k)
