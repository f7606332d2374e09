import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.llm import whitening
from cinerank.llm.whitening import Whitening, fit_whitening, jacobi_davidson, minres, op12_whitening, partition_sums, whiten


def brute(vectors, k=16):
    """(n, x by row, centred x by row, eigenvalues, eigenvectors, trace) by a dense eigensolver."""
    x = np.array([np.floor(64 * np.asarray(v, float)) + 1_000_000 for v in vectors]).astype(np.int64)
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(0)
    cov = centred.T @ centred / len(fit)
    values, vec = np.linalg.eigh(cov)
    return fit, x, values[::-1][:k], vec[:, ::-1][:, :k], np.trace(cov)


def check(got, vectors, ids, k=16):
    fit, x, values, vec, trace = brute(vectors, k)
    n, s = len(fit), fit.sum(0)
    got = got.sort_values(["vec_id", "component"])
    k = min(k, x.shape[1])
    assert len(got) == len(x) * k and (got.n == n).all()
    order = np.argsort(ids, kind="stable")
    want = ((n * x - s) ** 2).sum(1)[order]
    assert got.deviation.to_numpy().reshape(-1, k)[:, 0].tolist() == want.tolist()
    z = got.whitened.to_numpy().reshape(-1, k)
    ref = ((x - s / n) @ vec / np.sqrt(values))[order]
    sign = np.sign((z * ref).sum(0))
    assert np.abs(z * sign - ref).max() < 1e-9
    assert np.allclose(got.explained.to_numpy().reshape(-1, k)[0], values / trace, rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_query(spark):
    from tests.conftest import SF_MEDIUM
    table = spark.read.parquet(f"{SF_MEDIUM}/embeddings.parquet").toPandas()
    check(op12_whitening(spark, SF_MEDIUM).toPandas(), table.embedding.tolist(), table.vec_id.to_numpy())


def test_odd_rows(spark):
    """Nulls, NaN, infinities, other lengths, copies, and clashing columns."""
    rng = np.random.default_rng(2)
    good = [[float(v) for v in rng.standard_normal(5)] for _ in range(30)]
    good += good[:4] * 3
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf")] + [0.0] * 4, [1.0, 2.0]]
    rows = [(i, v) for i, v in enumerate(good + bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for c in ("x", "n", "id", "v", "component", "part", "sums", "d", "count"):
        df = df.withColumn(c, F.lit("clash"))
    check(whiten(df.repartition(3)).toPandas(), good, np.arange(len(good)), 5)
    assert whiten(df.where("vec_id < 0")).count() == 0
    assert whiten(df.where("vec_id = 3")).count() == 0                 # one vector has no variance
    two = whiten(df.where("vec_id in (3, 4)")).toPandas()
    assert two.component.tolist() == [1, 1] and np.allclose(np.abs(two.whitened), 1)
    assert whiten(df.where("vec_id is null")).columns == whiten(df).columns


def test_many_partial_sums(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MERGE", 3)
    df = spark.range(1000, numPartitions=10).select(F.array("id", F.lit(1).cast("long")).alias("x"))
    assert partition_sums(df, lambda x: x.sum(0) if len(x) else np.zeros(2, np.int64), (2,), np.int64).tolist() == [499500, 1000]


@pytest.mark.parametrize("d", [3, 20, 90, 400])
def test_jacobi_davidson(d):
    """Close values, restarts (d over the search space) and small dimensions."""
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = np.sort(np.concatenate([[150.0, 106.0][:d - 1], 60 + rng.random(d - 2 if d > 2 else 1) * 8]))[::-1]
    a = (q * values) @ q.T
    calls = []

    def product(y):
        calls.append(y.shape[1])
        return a @ y

    got, vec, residual = jacobi_davidson(product, d, 16)
    k = min(16, d)
    assert np.abs(got - values[:k]).max() < 1e-11 * 150 and residual.max() < 1e-12 * 150
    assert np.abs(vec.T @ vec - np.eye(k)).max() < 1e-13
    assert np.abs(np.abs((vec * q[:, :k]).sum(0)) - 1).max() < 1e-9
    assert d < 100 or len(calls) < 400


def test_rank_deficient():
    a = np.diag([5.0, 3.0] + [0.0] * 30)
    values, vec, residual = jacobi_davidson(lambda y: a @ y, 32, 16)
    assert np.allclose(values[:2], [5, 3]) and np.abs(values[2:]).max() < 1e-12 and residual.max() < 1e-12
    assert np.allclose(jacobi_davidson(lambda y: 0 * y, 8, 4)[0], 0)


def test_minres():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    b = np.column_stack([rng.standard_normal((20, 3)), np.zeros(20)])
    x = minres(lambda y: a @ y, b, 60, 1e-12)
    assert np.abs(a @ x - b).max() < 1e-8


def test_exact_deviation():
    model = Whitening(10**9, np.array([5, -7]), np.zeros((2, 0)), np.zeros(0), 0.0, np.zeros(0))
    x = np.array([[3, 2], [4000, 1]])
    assert model.deviation(x) == [None, None]
    model = Whitening(10**8, np.array([5, -7]), np.zeros((2, 0)), np.zeros(0), 0.0, np.zeros(0))
    assert model.deviation(x)[0] == (3 * 10**8 - 5)**2 + (2 * 10**8 + 7)**2 and model.deviation(x)[1] is None


def test_model(spark):
    from tests.conftest import SF_SMALL
    model = fit_whitening(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"), k=4)
    assert model.components.shape == (64, 4) and (np.diff(model.values) <= 0).all()
    assert model.residuals.max() < 1e-12 * model.values[0]
