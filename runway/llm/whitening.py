"""Operator 12: whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

Components c become integers x = floor(scale * c) + shift.  Their sums S and sums of squares are exact, so a centred
row A = x - S / n is an exact integer less a fraction, and the trace of the covariance is exact up to one rounding.

One pass over the rows takes a vector y to X y and, in the same task, to Xᵀ(X y), both on centred rows, and adds the
second up; the long left vectors u are combinations X c of the right ones, so the driver keeps c and Xᵀu (as long as a
vector) and no task has to store its part of u.  Every new left vector is freed of all earlier ones, from the inner products
that follow from Xᵀ(X y), and computed by another pass if that took most of its length; right vectors are freed of all
earlier ones twice.  X V = U B with B upper bidiagonal; its small SVD gives components and deviations.

The recurrence ends at the length of the vectors, or once the wanted triplets have converged and the squared
norm of X that B does not hold yet is less than the last of their squares, so none can be missing.  Where
the Krylov space is exhausted (as with repeated eigenvalues) it starts again from a random vector orthogonal to it.

Defined cases: vectors that are NULL, empty, hold NULL or non-finite components, or are of another length than most
(of equally frequent lengths, the longest) take no part; repeated rows and rows with a NULL id are rows like any
other; |floor(scale * c)| is at most 2**61; directions without variance have no component, so one row, or equal
rows only, give an empty result, as does an empty table; other columns are not read.
"""

from __future__ import annotations

import decimal
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import matrix, whole

_EXACT = decimal.Context(prec=38)


def integers(v: pa.Array, length: int, scale: int, shift: int) -> np.ndarray:
    return np.clip(np.floor(scale * matrix(v, length)), -2.0 ** 61, 2.0 ** 61).astype(np.int64) + shift


@dataclass
class Centre:
    """Exact mean S / n = whole + rest / n of each dimension."""
    n: int
    whole: np.ndarray
    rest: np.ndarray
    scale: int
    shift: int

    def offsets(self, v: pa.Array) -> np.ndarray:
        """x - whole."""
        return integers(v, len(self.whole), self.scale, self.shift) - self.whole

    def rows(self, v: pa.Array) -> np.ndarray:
        return self.offsets(v).astype(np.float64) - self.rest / self.n

    def deviations(self, v: pa.Array) -> list[int]:
        """Sum over dimensions of (n * x - S)**2 of each row, exact."""
        y = self.offsets(v)
        if self.n * (int(np.abs(y).max(initial=0)) + 1) < 1 << 28 and len(self.whole) < 1 << 7:
            return ((self.n * y - self.rest) ** 2).sum(axis=1).tolist()
        return ((y.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(axis=1).tolist()


def _decimals(values) -> pa.Array:
    return pa.array([[_EXACT.create_decimal(int(x)) for x in values]], pa.list_(pa.decimal128(38, 0)))


def _sums(length: int, scale: int, shift: int):
    def run(batches):
        total, square = np.zeros(length, dtype=object), np.zeros(length, dtype=object)
        for batch in batches:
            if batch.num_rows:
                x = integers(batch.column(0), length, scale, shift)
                safe = (int(np.abs(x).max()) + 1) ** 2 * len(x) < 1 << 62
                x = x if safe else x.astype(object)
                total, square = total + x.sum(axis=0).astype(object), square + (x ** 2).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([_decimals([*total, *square])], ["s"])
    return run


def _added(parts: DataFrame, column: str) -> list:
    """Sum by place of the arrays that the tasks return: one row for each place reaches the driver."""
    rows = parts.select(F.posexplode(column).alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()
    return [r["x"] for r in sorted(rows, key=lambda r: r["at"])]


def _product(centre: Centre, y: np.ndarray):
    """A task's part of Xᵀ(X y)."""
    def run(batches):
        out = np.zeros(len(y))
        for batch in batches:
            if batch.num_rows:
                a = centre.rows(batch.column(0))
                out += a.T @ (a @ y)
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], ["s"])
    return run


def _gram(centre: Centre, weights: np.ndarray):
    """A task's part of the sums of the whitened rows and of their products."""
    def run(batches):
        k = weights.shape[1]
        out = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = centre.rows(batch.column(0)) @ weights
                out += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array([out.ravel().tolist()], pa.list_(pa.float64()))], ["s"])
    return run


def _free(x: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2 if basis else 0):
        b = np.array(basis)
        x = x - b.T @ (b @ x)
    return x


def bidiagonal(product, length: int, energy: float, k: int, tolerance: float = 1e-15, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The k largest singular values of X and their right vectors (as columns); fewer if its rank is less.

    ``product(y)`` is Xᵀ(X y), ``energy`` the squared Frobenius norm of X.
    """
    rng = np.random.default_rng(seed)
    v, c, t = [], [], []  # right vectors, coefficients of the left ones u = X c, and Xᵀu
    alpha, beta = [], []
    nothing = np.sqrt(energy) * 1e-13

    def fresh() -> np.ndarray:
        x = _free(rng.normal(size=length), v)
        return x / np.linalg.norm(x)

    x = fresh()
    while True:
        v.append(x)
        y, g = x, product(x)
        size = np.sqrt(max(y @ g, 0.0))
        for again in range(3):
            before = np.sqrt(max(y @ g, 0.0))
            if c:
                inner = np.array(c) @ g  # uᵀ(X y) for every earlier u
                y, g = y - np.array(c).T @ inner, g - np.array(t).T @ inner
            after = np.sqrt(max(y @ g, 0.0))
            if after <= nothing or after > 0.5 * before or again == 2:
                break
            g = product(y)
        if after <= nothing:  # X x lies in the span of the earlier left vectors
            alpha.append(0.0)
            c.append(np.zeros(length))
            t.append(np.zeros(length))
            z = np.zeros(length)
        else:
            alpha.append(after)
            c.append(y / after)
            t.append(g / after)
            z = _free(t[-1], v)
        ended = len(v) == length
        step = 0.0 if ended else float(np.linalg.norm(z))
        p, sigma, qt = np.linalg.svd(np.diag(alpha) + np.diag(beta, 1))
        held = float((sigma ** 2).sum()) + step ** 2
        if not ended and len(sigma) >= k:
            residual = step * np.abs(p[-1, :k]).max()
            ended = residual <= tolerance * sigma[0] and energy - held < 0.99 * sigma[k - 1] ** 2
        if ended or size <= nothing and energy - held <= energy * 1e-13:
            break
        if step <= nothing:
            beta.append(0.0)
            x = fresh()
        else:
            beta.append(step)
            x = _free(z / step, v)
            x /= np.linalg.norm(x)
    right = np.array(v).T @ qt.T
    found = int((sigma[:k] > max(nothing, 1e-12 * sigma[0])).sum())
    return sigma[:found], right[:, :found] / np.linalg.norm(right[:, :found], axis=0)


def _whitened(centre: Centre, weights: np.ndarray):
    def run(batches):
        k = weights.shape[1]
        for batch in batches:
            n = batch.num_rows
            w = centre.rows(batch.column(1)) @ weights
            deviation = pa.array([_EXACT.create_decimal(d) for d in centre.deviations(batch.column(1))], pa.decimal128(38, 0))
            row = pa.array(np.repeat(np.arange(n), k))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                                              deviation.take(row), pa.array(w.ravel())], ["vec_id", "component", "deviation", "whitened"])
    return run


@dataclass
class Whitening:
    """Components (columns), their variances, the covariance's trace, and how far the whitened covariance is from one."""
    centre: Centre
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float

    @property
    def weights(self) -> np.ndarray:
        return self.components / np.sqrt(self.variances)


def fit(rows: DataFrame, n: int, length: int, k: int, scale: int, shift: int) -> Whitening | None:
    """Of staged rows (v) as ``vectors.whole`` gives them; None if they have no variance."""
    vectors = rows.select("v")
    sums = [int(x) for x in _added(vectors.mapInArrow(_sums(length, scale, shift), "s array<decimal(38,0)>"), "s")]
    total, square = sums[:length], sums[length:]
    trace = Fraction(sum(n * q - s * s for s, q in zip(total, square)), n * n)
    if not trace:
        return None
    centre = Centre(n, np.array([s // n for s in total], dtype=np.int64), np.array([s % n for s in total], dtype=np.int64), scale, shift)

    def product(y: np.ndarray) -> np.ndarray:
        return np.array(_added(vectors.mapInArrow(_product(centre, y), "s array<double>"), "s"))

    sigma, components = bidiagonal(product, length, float(trace * n), k)
    found = Whitening(centre, components, sigma ** 2 / n, float(trace), 0.0)
    sums = np.array(_added(vectors.mapInArrow(_gram(centre, found.weights), "s array<double>"), "s")).reshape(-1, len(sigma))
    covariance = sums[:-1] / n - np.outer(sums[-1] / n, sums[-1] / n)
    found.identity_error = float(np.abs(covariance - np.eye(len(sigma))).max())
    return found


def whiten(df: DataFrame, k: int = 8, scale: int = 1024, shift: int = 100_000, id_col: str | Column = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1, by falling variance), n, deviation (decimal), whitened, explained, identity_error."""
    spark = df.sparkSession
    rows, n, length = whole(df, {"vec_id": F.col(id_col).cast("long")}, vector_col, "whitening_rows")
    model = fit(rows, n, length, min(k, length), scale, shift) if n else None
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
                                         "explained double, identity_error double")
    found = rows.select("vec_id", "v").mapInArrow(_whitened(model.centre, model.weights),
                                                  "vec_id long, component int, deviation decimal(38,0), whitened double")
    explained = F.element_at(F.array(*[F.lit(float(e / model.trace)) for e in model.variances]), F.col("component"))
    return found.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"),
                        F.lit(model.identity_error).alias("identity_error"))
