import numpy as np
import pytest
from pyspark.sql import functions as F

from runway.llm import queries, whitening

NAN, INF = float("nan"), float("inf")


def brute(vectors, k=8):
    """Whitened rows up to sign, shares of the trace, and exact deviations."""
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    y = n * x.astype(object) - s.astype(object)
    centred = (y / n).astype(np.float64)
    e, vec = np.linalg.eigh(centred.T @ centred / n)
    e, vec = e[::-1][:k], vec[:, ::-1][:, :k]
    return (y ** 2).sum(axis=1).tolist(), centred @ vec / np.sqrt(e), e / (centred ** 2).sum() * n


def compare(rows, vectors, k):
    deviation, white, explained = brute([v for _, v in vectors], k)
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(rows) == len(vectors) * k
    mine = np.array([[got[i][c + 1]["whitened"] for c in range(k)] for i, _ in vectors])
    sign = np.sign((mine * white).sum(axis=0))
    np.testing.assert_allclose(mine * sign, white, atol=1e-8)
    for (i, _), d in zip(vectors, deviation):
        r = got[i][1]
        assert int(r["deviation"]) == d and r["n"] == len(vectors) and r["identity_error"] < 1e-9
        assert [got[i][c + 1]["explained"] for c in range(k)] == pytest.approx(explained, rel=1e-9)


def frame(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    for c in ("v", "row", "n", "component", "whitened", "s", "at", "x"):
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3)


@pytest.mark.parametrize("n,dim,k", [(300, 16, 8), (40, 5, 5), (200, 1, 1)])
def test_components_equal_those_of_the_covariance(spark, n, dim, k):
    rng = np.random.default_rng(dim)
    x = (rng.normal(size=(n, dim)) * (1 + np.arange(dim)) @ rng.normal(size=(dim, dim))).astype(np.float32)
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(-1, None), (-2, [1.0] * (dim + 1)), (-3, [NAN] * dim), (-4, [None] * dim), (-5, [INF] * dim), (-6, [])]
    compare(whitening.whiten(frame(spark, vectors + odd)).collect(), vectors, k)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op12_whitening(spark, sf)
    assert got.dtypes[:7] == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
                              ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    vectors = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(got.collect(), vectors, 8)


def test_repeated_eigenvalues_and_low_rank(spark):
    # Four equal eigenvalues, two of zero: the Krylov space of one start vector has a dimension of one.
    axes = [[s * 3.0 if i == j else 0.0 for i in range(6)] for j in range(4) for s in (1, -1)]
    got = whitening.whiten(frame(spark, [(i, v) for i, v in enumerate(axes)])).collect()
    assert len(got) == 8 * 4 and all(r["explained"] == pytest.approx(0.25) for r in got)
    assert all(r["identity_error"] < 1e-9 for r in got)


def test_large_values_stay_exact(spark):
    vectors = [(i, [float(2 ** 20 + 37 * i), float(i * i)]) for i in range(9)]
    compare(whitening.whiten(frame(spark, vectors)).collect(), vectors, 2)


def test_no_variance(spark):
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])]).limit(0)).count() == 0
    again = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 8.0])])).collect()
    assert sorted((r["vec_id"] or 0, r["n"]) for r in again) == [(0, 3), (1, 3), (1, 3)]


def test_early_end_misses_nothing():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 30)) * 0.5 ** np.arange(30)
    calls = []

    def product(y):
        calls.append(1)
        return x.T @ (x @ y)

    sigma, v = whitening.bidiagonal(product, 30, float((x ** 2).sum()), 4)
    np.testing.assert_allclose(sigma, np.linalg.svd(x)[1][:4], rtol=1e-12)
    np.testing.assert_allclose(np.abs(np.linalg.svd(x)[2][:4] @ v), np.eye(4), atol=1e-10)
    assert len(calls) < 30
