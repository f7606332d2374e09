"""Operator 12, embedding whitening: block Jacobi-Davidson, matrix-free.

The covariance is only ever multiplied: each task centres its rows (exactly, as
(n x - S) / n), multiplies them with a narrow block and sums up; the driver holds
vectors of the embedding's dimension, never rows.  Correction equations of all
open pairs are solved together by MINRES, projected off the current Ritz vectors,
so that one distributed product serves them all; pairs whose residual is down to
double precision are locked and get no further corrections.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import map_arrow, stage, text_slices

#: Fixed values of the integer grid: entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Entries beyond +-LARGEST / SCALE count as that.
LARGEST = 1 << 52
#: Partial sums that the driver adds up itself; more are merged by tasks first.
MERGE = 64
LONG = 1 << 63


# ---- distributed sums ------------------------------------------------------------

def matrix(column: pa.Array) -> np.ndarray:
    """A list column (no nulls, equal lengths) as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def partition_sums(df: DataFrame, fn: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], dtype: type) -> np.ndarray:
    """The sum of ``fn`` over the blocks of ``df``'s column x: one partial sum a
    partition; beyond MERGE partitions they are merged by tasks, MERGE groups."""
    ship_package(df.sparkSession)
    schema = pa.schema([("part", pa.int32()), ("sums", pa.binary())])

    def block(rows) -> np.ndarray:
        return matrix(rows.column("x"))

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = np.zeros(shape, dtype)
        for batch in batches:
            for part in text_slices(batch):
                total += fn(block(part))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], schema=schema)

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["part"].to_pylist(), table["sums"].to_pylist()))
        total = sum((np.frombuffer(s, dtype) for _, s in rows), np.zeros(int(np.prod(shape)), dtype))
        return pa.Table.from_arrays([pa.array([rows[0][0] % MERGE], pa.int32()), pa.array([total.tobytes()], pa.binary())], schema=schema)

    sums = df.select("x").mapInArrow(partial, "part int, sums binary")
    if df.rdd.getNumPartitions() > MERGE:
        sums = sums.groupBy(F.col("part") % MERGE).applyInArrow(merge, "part int, sums binary")
    rows = sorted((r["part"], bytes(r["sums"])) for r in sums.collect())        # at most MERGE rows
    return sum((np.frombuffer(s, dtype).reshape(shape) for _, s in rows), np.zeros(shape, dtype))


# ---- Jacobi-Davidson ---------------------------------------------------------------

def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, rtol: float) -> np.ndarray:
    """Approximate solutions of symmetric systems, one a column; all columns share
    each call of ``apply``.  Ends when every column's residual is below ``rtol``."""
    m = rhs.shape[1]
    start = np.linalg.norm(rhs, axis=0)
    x, w, w_old, v_old = (np.zeros_like(rhs) for _ in range(4))
    beta, eta = np.zeros(m), start.copy()
    v = rhs / np.where(start > 0, start, 1)
    c = c_old = np.ones(m)
    s = s_old = np.zeros(m)
    alive = start > 0
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta * v_old
        new = np.linalg.norm(p, axis=0)
        rho0 = c * alpha - c_old * s * beta
        rho1 = np.hypot(rho0, new)
        rho2, rho3 = s * alpha + c_old * c * beta, s_old * beta
        alive = alive & (rho1 > 0)
        div = np.where(rho1 > 0, rho1, 1)
        c_old, c, s_old, s = c, rho0 / div, s, new / div
        w, w_old = (v - rho3 * w_old - rho2 * w) / div, w
        x = x + np.where(alive, c * eta, 0) * w
        eta = -s * eta
        alive = alive & (new > 1e-14 * np.abs(alpha)) & (np.abs(eta) > rtol * start)
        if not alive.any():
            break
        v_old, v, beta = v, p / np.where(new > 0, new, 1), new
    return x


def orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The part of ``new`` outside ``basis`` as orthonormal columns; columns that
    lie inside (to rounding) are left out."""
    kept = basis
    for column in new.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(3):
            column = column - kept @ (kept.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            kept = np.column_stack([kept, column])
    return kept[:, basis.shape[1]:]


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, seed: int = 0, guard: int = 4,
                    inner: int = 8, max_rounds: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residual norms) of the ``k`` largest eigenpairs of the
    positive semidefinite operator ``product`` (d x m block -> d x m block).

    A search space of at most 4 (k + guard) vectors (thick restart beyond) is
    expanded by the block's corrections; a pair is locked once its residual is at
    most 32 eps sqrt(d) times the largest value, and the end is reached when all k
    are, by a product made afresh.
    """
    k = min(k, d)
    block = min(d, k + guard)
    most = min(d, 4 * block)
    limit = 32 * np.finfo(float).eps * np.sqrt(d)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, block)))[0]
    image = product(basis)
    best = None
    for nr in range(max_rounds):
        h = basis.T @ image
        values, z = np.linalg.eigh((h + h.T) / 2)
        values, z = values[::-1], z[:, ::-1]
        ritz, shown = basis @ z, image @ z
        residual = shown - ritz * values
        size = np.linalg.norm(residual, axis=0)
        goal = limit * max(values[0], np.finfo(float).tiny)
        full = basis.shape[1] == d
        if (size[:k] <= goal).all() or full:
            vectors = np.linalg.qr(ritz[:, :k])[0]
            vectors *= np.sign((vectors * ritz[:, :k]).sum(0))
            fresh = product(vectors)
            own = (vectors * fresh).sum(0)
            left = np.linalg.norm(fresh - vectors * own, axis=0)
            if best is None or left.max() < best[2].max():
                best = own, vectors, left
            if left.max() <= goal or full and nr >= max_rounds - 2:
                break
            # Rounding of a long-kept image: begin again with fresh ones.
            extra = ritz[:, k:block]
            basis = np.column_stack([vectors, orthonormal(extra, vectors)])
            image = np.column_stack([fresh, product(basis[:, k:])]) if basis.shape[1] > k else fresh
            if full and basis.shape[1] == d:
                break
            max_rounds = min(max_rounds, nr + 12)
            continue
        open_ = np.flatnonzero(size[:block] > goal)[:max(1, d - basis.shape[1])]     # locked pairs get no correction
        front, shift = ritz[:, :block], values[open_]

        def projected(y):
            y = y - front @ (front.T @ y)
            y = product(y) - y * shift
            return y - front @ (front.T @ y)

        step = minres(projected, -residual[:, open_], inner, 0.5 ** (nr + 2))
        if basis.shape[1] + len(open_) > most:
            basis, image = ritz[:, :2 * block], shown[:, :2 * block]
        new = orthonormal(np.column_stack([step, residual[:, open_]]), basis)[:, :len(open_)]
        if not new.shape[1]:
            new = orthonormal(np.random.default_rng(seed + nr + 1).standard_normal((d, len(open_))), basis)
        basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
    if best is None:
        raise ArithmeticError(f"{k} pairs did not converge in {max_rounds} rounds: residuals {size[:k]}")
    order = np.argsort(-best[0], kind="stable")
    return best[0][order], best[1][:, order], best[2][order]


# ---- whitening ---------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``n`` vectors, exact per-dimension ``sums`` (of x -
    OFFSET), the components (d x k) and their values, and the covariance's trace."""
    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    residuals: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x * self.n - self.sums).astype(float) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2; null beyond a long."""
        far = x * self.n - self.sums
        top = int(np.abs(far).max(initial=0))
        if top * top * max(1, far.shape[1]) < LONG:
            return (far * far).sum(1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in far]
        return [v if v < LONG else None for v in exact]


def grid(vector: Column) -> Column:
    """x - OFFSET of a vector, as longs."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("long"))


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite entries (NaN exceeds every number)."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= F.lit(np.finfo(float).max), F.lit(False))), F.lit(False))


def dimension(df: DataFrame, vec_col: str) -> int:
    """The most frequent length of the usable vectors (of equals the larger); 0 if none."""
    sizes = df.where(usable(F.col(vec_col))).groupBy(F.size(vec_col).alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    first = sizes.first()
    return first["d"] if first else 0


def fit_whitening(df: DataFrame, vec_col: str = "embedding", k: int = 16, d: int | None = None) -> Whitening | None:
    """The whitening of the distinct grid vectors of ``df``; None if none is left.
    Components without variance (values within rounding of zero) are left out."""
    d = dimension(df, vec_col) if d is None else d
    if not d:
        return None
    vector = F.col(vec_col)
    fit = stage(df.where(usable(vector) & (F.size(vector) == d)).select(grid(vector).alias("x")).distinct())
    n = fit.count()
    sums = partition_sums(fit, lambda x: x.sum(0) if len(x) else np.zeros(d, np.int64), (d,), np.int64)
    base = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, np.zeros(0))

    def squares(x):
        return (base.centred(x) ** 2).sum(0) if len(x) else np.zeros(d)

    trace = float(partition_sums(fit, squares, (d,), float).sum() / n)

    def product(block: np.ndarray) -> np.ndarray:
        def multiply(x):
            if not len(x):
                return np.zeros(block.shape)
            rows = base.centred(x)
            return rows.T @ (rows @ block)
        return partition_sums(fit, multiply, block.shape, float) / n

    values, vectors, residuals = jacobi_davidson(product, d, k)
    real = values > 64 * d * np.finfo(float).eps * max(values[0], 0)
    return Whitening(n, sums, vectors[:, real], values[real], trace, residuals[real])


def identity_error(df: DataFrame, model: Whitening, vec_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened distinct vectors' covariance minus
    the identity (0 without components)."""
    d, k = model.components.shape
    vector = F.col(vec_col)
    fit = df.where(usable(vector) & (F.size(vector) == d)).select(grid(vector).alias("x")).distinct()

    def moments(x):
        z = model.whiten(x) if len(x) else np.zeros((0, k))
        return np.vstack([z.T @ z, z.sum(0)])

    if not k:
        return 0.0
    total = partition_sums(stage(fit), moments, (k + 1, k), float) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(df: DataFrame, k: int = 16, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per usable row of ``df`` and component: ``id_col``, component (from 1
    by falling value), n, deviation, whitened, explained and identity_error.

    Rows whose vector is null or has null or non-finite entries are dropped, and so
    are those (empty ones too) of another length than most have.  Entries c become
    x = floor(64 c) + 1000000; the fit is over the distinct x vectors.  deviation is
    exact, and null where a long can't hold it; entries beyond 2^46 count as that.
    Components without variance can't be whitened and are left out: a table with
    one distinct vector, or none, gives no rows.  Repeated rows and null ids each
    get their rows; other columns aren't read.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    model = fit_whitening(rows, "v", k)
    schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double"
    if model is None:
        out = rows.where(F.lit(False)).select("id", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in schema.split(", ")[1:]])
        return out.withColumnRenamed("id", id_col).withColumn("identity_error", F.lit(0.0))
    error = identity_error(rows, model, "v")
    d, k = model.components.shape
    share = model.values / model.trace if k else np.zeros(0)

    def project(batch):
        x = matrix(batch["x"])
        if not len(x) or not k:
            return None
        at = np.repeat(np.arange(len(x)), k)
        deviation = model.deviation(x)
        return {"id": batch["id"].take(pa.array(at)), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                "n": np.full(len(at), model.n), "deviation": [v for v in deviation for _ in range(k)],
                "whitened": model.whiten(x).ravel(), "explained": np.tile(share, len(x))}

    vector = F.col("v")
    own = rows.where(usable(vector) & (F.size(vector) == d)).select("id", grid(vector).alias("x"))
    return map_arrow(own, project, schema).withColumnRenamed("id", id_col).withColumn("identity_error", F.lit(error))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
