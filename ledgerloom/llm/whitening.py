"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Entries become whole numbers, ``floor(scale * c) + offset``, so that counts and sums are exact and
do not depend on how rows are dealt to tasks.  Rows are centred on the rounded mean before anything is
multiplied; what the rounding leaves of the mean is taken off in whole numbers, so the covariance
is the exact one, rounded once.  It is a dims x dims matrix whatever the number of rows: every task adds
up its rows, Spark adds up the tasks, and the driver factors the sum.

The factor: pivoted Cholesky gives a triangular L with ``L L' = V``, which stops where nothing is left of the diagonal
(that is the rank).  Rotations of pairs of columns of L make them orthogonal; squared column norms are
then the eigenvalues and normalised columns the components, without forming a product again.

Nulls and edges: rows whose vector is null or holds null or non-finite entries are left out, and so are vectors of
another length than most (ties: the longer).  Zero vectors stay.  Rows that repeat an id, or have
none, are rows of their own.  Directions without variance are no components, so fewer than ``most`` may come out,
and none (no rows) where all vectors are equal or the table is empty.  Entries beyond 2^50 / scale are
taken at that bound; a ``deviation`` beyond a long is null.  Equal eigenvalues have components in any
rotation, but the same for all rows.  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_value, stored
from ledgerloom.llm.vectors import matrix

by_value(__name__)

BOUND = 1 << 50  # of scaled entries
EXACT = 1 << 53  # whole doubles
BLOCK = 4096  # rows that are multiplied at once
WHOLE = "decimal(38,0)"


def fit_rows(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """(id, v) of the rows that take part, stored, and their length."""
    v = F.col("v")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).where("v is not null")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite)
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    dims = top.d if top else 0
    return stored(rows.where(F.size("v") == dims), "vectors"), dims


def whole(vectors: np.ndarray, scale: float, offset: int) -> np.ndarray:
    return np.clip(np.floor(vectors * scale), -BOUND, BOUND).astype(np.int64) + offset


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def sums(rows: DataFrame, dims: int, scale: float, offset: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of every dimension."""

    def run(batches):
        n, total = 0, [0] * dims
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):  # 2 ** 12 numbers of some 2 ** 50: their sum fits
                x = whole(matrix(batch.column(1).slice(at, BLOCK), dims), scale, offset)
                n += len(x)
                total = [a + int(b) for a, b in zip(total, x.sum(axis=0), strict=True)]
        places = pa.array([*range(dims), dims], pa.int32())
        yield pa.RecordBatch.from_arrays([places, _decimals([*total, n])], names=["place", "total"])

    parts = rows.mapInArrow(run, f"place int, total {WHOLE}")
    found = {r.place: int(r.total) for r in parts.groupBy("place").agg(F.sum("total").alias("total")).collect()}
    return found.get(dims, 0), [found.get(i, 0) for i in range(dims)]


def _products(y: np.ndarray) -> np.ndarray:
    """The exact scatter of whole numbers, as Python's integers."""
    most = int(np.abs(y).max(initial=0))
    out = np.zeros((y.shape[1], y.shape[1]), object)
    step = EXACT // (most * most) if most else len(y)
    if step:  # partial sums stay below 2 ** 53, where doubles are exact
        for at in range(0, len(y), max(1, min(step, len(y)))):
            part = y[at : at + step].astype(np.float64)
            out += (part.T @ part).astype(np.int64).astype(object)
        return out
    wide = y.astype(object)
    return wide.T @ wide


def covariance(rows: DataFrame, dims: int, n: int, total: list[int], scale: float, offset: int) -> np.ndarray:
    """The covariance with divisor ``n``, every entry rounded once from its exact value."""
    middle = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)  # the nearest whole number to the mean

    def run(batches):
        scatter = np.zeros((dims, dims), object)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                scatter += _products(whole(matrix(batch.column(1).slice(at, BLOCK), dims), scale, offset) - middle)
        upper = np.triu_indices(dims)
        places = pa.array(upper[0] * dims + upper[1], pa.int32())
        yield pa.RecordBatch.from_arrays([places, _decimals(scatter[upper])], names=["place", "total"])

    parts = rows.mapInArrow(run, f"place int, total {WHOLE}").groupBy("place").agg(F.sum("total").alias("total"))
    rest = [s - n * int(m) for s, m in zip(total, middle, strict=True)]
    out = np.zeros((dims, dims))
    for r in parts.collect():  # one row per pair of dimensions
        i, j = divmod(r.place, dims)
        out[i, j] = out[j, i] = float(Fraction(n * int(r.total) - rest[i] * rest[j], n * n))
    return out


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L of as many columns as the rank, with ``L L' = v``; rows in the order of ``v``.

    By pivots a lower triangle; what the diagonal has left below rounding is no rank.
    """
    dims = len(v)
    left, columns = v.diagonal().astype(float).copy(), []
    least = dims * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    used = np.zeros(dims, bool)
    for _ in range(dims):
        pivot = int(np.argmax(np.where(used, -np.inf, left)))
        if left[pivot] <= least:
            break
        column = v[:, pivot].astype(float).copy()
        for c in columns:
            column -= c * c[pivot]
        column[used] = 0.0
        column /= np.sqrt(column[pivot])
        columns.append(column)
        used[pivot] = True
        left = np.where(used, 0.0, left - column**2)
    return np.array(columns).T if columns else np.zeros((dims, 0))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms and normalised columns of the factor, once rotations made its columns orthogonal."""
    a = factor.copy()
    close = 1e-15 * np.sqrt(len(a))
    for _ in range(sweeps):
        worst = 0.0
        for i in range(a.shape[1] - 1):
            for j in range(i + 1, a.shape[1]):
                p, q, r = a[:, i] @ a[:, i], a[:, j] @ a[:, j], a[:, i] @ a[:, j]
                if p == 0 or q == 0 or abs(r) <= close * np.sqrt(p * q):
                    continue
                worst = max(worst, abs(r) / np.sqrt(p * q))
                tau = (q - p) / (2 * r)
                t = np.copysign(1.0, tau) / (abs(tau) + np.hypot(1.0, tau))
                c = 1 / np.hypot(1.0, t)
                s = c * t
                a[:, i], a[:, j] = c * a[:, i] - s * a[:, j], s * a[:, i] + c * a[:, j]
        if worst <= close:
            break
    values = (a * a).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    values, a = values[order], a[:, order]
    return values, a / np.sqrt(values)


@dataclass(frozen=True)
class Whitening:
    """What was learned: ``values`` and ``components`` (columns) by falling value."""

    n: int
    total: list[int]
    scale: float
    offset: int
    values: np.ndarray
    components: np.ndarray
    trace: float

    def centred(self, vectors: np.ndarray) -> np.ndarray:
        """The rows less the mean; the whole part of the mean is taken off exactly first."""
        x = whole(vectors, self.scale, self.offset)
        base = np.array([s // self.n for s in self.total], np.int64)
        rest = np.array([float(Fraction(s % self.n, self.n)) for s in self.total])
        return (x - base) - rest

    def project(self, vectors: np.ndarray, most: int) -> np.ndarray:
        return self.centred(vectors) @ self.components[:, :most] / np.sqrt(self.values[:most])

    def deviations(self, vectors: np.ndarray) -> list[int | None]:
        """The exact sum over the dimensions of (n * x - total) squared; None beyond a long."""
        x = whole(vectors, self.scale, self.offset)
        base = np.array([s // self.n for s in self.total], np.int64)
        rest = np.array([s % self.n for s in self.total], np.int64)
        apart = x - base
        largest = self.n * (int(np.abs(apart).max(initial=0)) + 1)
        if largest * largest * max(1, x.shape[1]) < 1 << 63:
            return ((self.n * apart - rest) ** 2).sum(axis=1).tolist()
        wide = apart.astype(object) * self.n - rest.astype(object)
        return [d if d < 1 << 63 else None for d in (int(v) for v in (wide**2).sum(axis=1))]


def fit(rows: DataFrame, dims: int, scale: float = 1024, offset: int = 100_000) -> Whitening | None:
    """None where there are no rows or nothing varies."""
    n, total = sums(rows, dims, scale, offset) if dims else (0, [])
    if not n:
        return None
    v = covariance(rows, dims, n, total, scale, offset)
    values, components = one_sided_jacobi(pivoted_cholesky(v))
    return Whitening(n, total, scale, offset, values, components, float(np.trace(v))) if len(values) else None


def identity_error(rows: DataFrame, model: Whitening, dims: int, most: int) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity.

    Tasks send count, mean and centred products, which are merged pairwise by their means.
    """
    k = min(most, len(model.values))

    def run(batches):
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                w = model.project(matrix(batch.column(1).slice(at, BLOCK), dims), k)
                n, mean, products = _merged((n, mean, products), (len(w), w.mean(axis=0), (w - w.mean(axis=0)).T @ (w - w.mean(axis=0))))
        flat = pa.array([products.ravel().tolist()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())), flat], names=["n", "mean", "products"])

    parts = rows.mapInArrow(run, "n long, mean array<double>, products array<double>").where("n > 0")
    n = F.sum("n")
    means = parts.select("n", F.posexplode("mean").alias("i", "m")).groupBy("i").agg((F.sum(F.col("n") * F.col("m")) / n).alias("m"))
    middle = np.zeros(k)
    for r in means.collect():
        middle[r.i] = r.m
    apart = F.transform("mean", lambda m, i: m - F.get(F.array(*[F.lit(float(m)) for m in middle]), i))
    # the products of a task about the common mean
    cell = F.col("p") + F.col("n") * F.get("apart", F.floor(F.col("i") / k).cast("int")) * F.get("apart", F.col("i") % k)
    spread = parts.withColumn("apart", apart).select("n", "apart", F.posexplode("products").alias("i", "p"))
    found = spread.groupBy("i").agg(F.sum(cell).alias("p"))
    table = np.zeros(k * k)
    for r in found.collect():
        table[r.i] = r.p / model.n
    return float(np.abs(table.reshape(k, k) - np.eye(k)).max())


def _merged(one, two):
    n = one[0] + two[0]
    if not n:
        return one
    gap = two[1] - one[1]
    return n, one[1] + gap * (two[0] / n), one[2] + two[2] + np.outer(gap, gap) * (one[0] * two[0] / n)


def whiten(
    df: DataFrame, most: int = 8, scale: float = 1024, offset: int = 100_000, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """``id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    schema = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, dims = fit_rows(df, id_col, vec_col)
    model = fit(rows, dims, scale, offset)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    k = min(most, len(model.values))
    error = identity_error(rows, model, dims, most)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                vectors = matrix(part.column(1), dims)
                rows, places = np.arange(len(vectors)).repeat(k), np.tile(np.arange(k), len(vectors))
                deviation = pa.array(model.deviations(vectors), pa.int64())
                columns = [
                    part.column(0).take(pa.array(rows)),
                    pa.array(places + 1, pa.int32()),
                    pa.array(np.full(len(rows), model.n), pa.int64()),
                    deviation.take(pa.array(rows)),
                    pa.array(model.project(vectors, k).ravel()),
                    pa.array((model.values / model.trace)[places]),
                    pa.array(np.full(len(rows), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return rows.mapInArrow(run, schema)
