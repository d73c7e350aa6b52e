"""Embedding whitening: eigenvectors in single precision, refined in higher precision by matrix products.

Entries become integers (``floor(64 * c) + 1000000``), so everything up to the covariance is exact: the distinct
vectors are counted and summed, then centred by the rounded means, multiplied, and added up as integers; the
covariance is the exact quotient, whatever the number of partitions. Its eigenvectors are first taken in float32,
then corrected by Ogita and Aishima's iteration: with R = I - X'X and S = X'VX, the correction X E of quadratic
convergence needs nothing but matrix products, done in extended precision. Eigenvalues that lie closer together than
the error bound allows to tell apart form a cluster; a cluster is solved as a small problem of its own (S of its
columns, shifted by its centre and scaled), its basis is rotated, and the iteration goes on.

What the driver holds is d x d, by the dimension alone; the rows stay in Spark.

Defined results: null vectors and such with null or non-finite entries have no rows; where dimensions differ, the most
frequent one counts (of equally frequent ones the larger) and other vectors have no rows; zero vectors take part;
repeated rows have rows each, and count once in the fit; a null id stays null; with fewer dimensions than ``components``
there are that many; a component without variance has whitened values and an explained share of 0 and no part in
the identity error; ``deviation`` stops at the largest long; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
ROUNDS = 40
FINE, HALF = 10 ** 15, 10 ** 28
CELLS = "cell int, high decimal(38, 0), low decimal(38, 0)"
FLAT = 1e-13  # an eigenvalue below this share of the largest is none
_EXACT = 1 << 53
_LONG = (1 << 63) - 1


# --- refinement of eigenvectors ------------------------------------------------------------------

def refined_eigenvectors(v: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns) of a symmetric matrix, in ``np.longdouble``."""
    wide = np.longdouble
    v = v.astype(wide)
    d = len(v)
    size = np.abs(v).max() if d else wide(0)
    if not d or size == 0:
        return np.zeros(d, wide), np.eye(d, dtype=wide)
    v = v / size
    x = np.linalg.eigh(v.astype(np.float32))[1].astype(wide)[:, ::-1]
    eps, last = np.finfo(wide).eps, np.inf
    for _ in range(rounds):
        r = np.eye(d, dtype=wide) - x.T @ x
        s = x.T @ v @ x
        s = (s + s.T) / 2
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(value)
        doubt = 2 * (np.sqrt((off * off).sum()) + np.abs(value).max() * np.sqrt((r * r).sum()))
        gap = value[None, :] - value[:, None]
        near = np.abs(gap) <= max(doubt, 8 * d * eps)
        e = np.where(near, r / 2, (s + value[None, :] * r) / np.where(near, 1, gap))
        x = x + x @ e
        clusters = _clusters(value, max(doubt, 8 * d * eps))
        for own in clusters:
            x[:, own] = x[:, own] @ _cluster_basis(v, x[:, own])
        change = max(np.abs(e).max(), max([_off(v, x[:, own]) for own in clusters], default=wide(0)))
        if change < 16 * d * eps or change >= last and change < 1e-15:
            break
        last = change
    r = np.eye(d, dtype=wide) - x.T @ x
    x = x + x @ r / 2
    value = ((v @ x) * x).sum(axis=0) * size
    by = np.argsort(-value, kind="stable")
    return value[by], x[:, by]


def _clusters(value: np.ndarray, doubt) -> list[np.ndarray]:
    """Columns whose values follow one another more closely than ``doubt``, two at least."""
    by = np.argsort(-value, kind="stable")
    cut = np.flatnonzero(-np.diff(value[by]) > doubt) + 1
    return [c for c in np.split(by, cut) if len(c) > 1]


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Columns that are nearly orthonormal, made so (Newton's iteration for the polar factor)."""
    for _ in range(3):
        x = x + x @ (np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2
    return x


def _cluster_basis(v: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Rotation that makes the columns of a cluster eigenvectors: a small dense problem. What remains after the shift by
    the cluster's centre is scaled up, so double precision resolves differences far below that of the whole."""
    s = x.T @ (v @ x)
    s = (s + s.T) / 2
    s = s - np.eye(len(s), dtype=s.dtype) * (np.trace(s) / len(s))
    size = np.abs(s).max()
    if size == 0:
        return np.eye(len(s), dtype=s.dtype)
    return _orthonormal(np.linalg.eigh((s / size).astype(np.float64))[1][:, ::-1].astype(s.dtype))


def _off(v: np.ndarray, x: np.ndarray):
    s = x.T @ (v @ x)
    return np.abs(s - np.diag(np.diag(s))).max()


# --- exact sums over the rows --------------------------------------------------------------------

def integer_entries(embedding: Column) -> Column:
    """``floor(64 * c) + 1000000`` of every entry c as a double; beyond the longs, the nearest long that is left."""
    scaled = lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(9.2e18)), F.lit(-9.2e18))).cast("long") + OFFSET
    return F.transform(embedding, scaled)


def finite(embedding: Column) -> Column:
    return F.coalesce(F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))), F.lit(False))


def _blocks(batches: Iterator[pa.RecordBatch], base: np.ndarray) -> Iterator[np.ndarray]:
    """Rows less ``base``, as many at a time as have exact products in doubles, else as Python integers."""
    for batch in batches:
        column = batch.column(0)
        if not len(column):
            continue
        x = column.flatten().to_numpy().reshape(len(column), -1)
        lo = 0
        while lo < len(x):
            rows = x[lo:lo + 4096]
            most = max(int(rows.max()) - int(base.min()), int(base.max()) - int(rows.min()))
            if most * most * len(rows) < _EXACT:
                yield (rows - base).astype(np.float64)
                lo += len(rows)
            elif len(rows) > 1 and most * most < _EXACT:
                few = max(1, _EXACT // (most * most) - 1)
                yield (rows[:few] - base).astype(np.float64)
                lo += few
            else:
                yield rows.astype(object) - base.astype(object)
                lo += len(rows)


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of rows, and the sum of every dimension."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for x in _blocks(batches, np.zeros(dim, np.int64)):
            n, total = n + len(x), total + [int(t) for t in x.sum(axis=0)]
        if n:
            yield _cells({0: n} | {k + 1: t for k, t in enumerate(total)})

    return _added(fit.select("x").mapInArrow(rows, CELLS), lambda got: (got[0], [got[k + 1] for k in range(dim)]))


def _cells(values: dict[int, int]) -> pa.RecordBatch:
    """Whole numbers of any size, as two decimals each."""
    parts = [divmod(int(v), HALF) for v in values.values()]
    decimals = [pa.array([Decimal(x[k]) for x in parts], pa.decimal128(38, 0)) for k in range(2)]
    return pa.RecordBatch.from_arrays([pa.array(list(values), pa.int32()), *decimals], names=["cell", "high", "low"])


def _added(cells: DataFrame, use):
    """The cells' sums, a number that depends on the dimension only."""
    total = cells.groupBy("cell").agg(*[F.sum(c).cast("decimal(38, 0)").alias(c) for c in ("high", "low")])
    return use({r["cell"]: int(r["high"]) * HALF + int(r["low"]) for r in total.collect()})


def _covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Exact, rounded once: products are of rows centred by the rounded means, and what the rounding left is taken off as integers."""
    dim = len(sums)
    base = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    i, j = np.triu_indices(dim)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(i), object)
        for x in _blocks(batches, base):
            total = total + [int(t) for t in (x.T @ x)[i, j]]
        if total.any():
            yield _cells(dict(enumerate(total)))

    got = _added(fit.select("x").mapInArrow(rows, CELLS), dict)
    left = [s - n * int(b) for s, b in zip(sums, base)]
    out = np.zeros((dim, dim), np.longdouble)
    for cell, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        exact = Fraction(n * got.get(cell, 0) - left[a] * left[b], n * n)
        high = float(exact)
        out[a, b] = out[b, a] = np.longdouble(high) + np.longdouble(float(exact - Fraction(high)))
    return out


# --- the operator --------------------------------------------------------------------------------

@dataclass
class Whitening:
    """``base`` + ``rest`` / n: the means; columns of ``axes``: eigenvectors over the roots of ``values`` (0 without variance)."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of integer vectors. The means are taken off as integers and a rest below 1."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([float(Fraction(s % self.n, self.n)) for s in self.sums])
        return ((x - base).astype(np.float64) - rest) @ self.axes

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum of (n x - S)^2 over the dimensions, exact."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], object)
        y = x - base
        if not len(x) or (max(int(y.max()), -int(y.min())) + 1) ** 2 * self.n ** 2 * x.shape[1] < _LONG:
            y = y * self.n - rest.astype(np.int64)
            return (y * y).sum(axis=1)
        y = y.astype(object) * self.n - rest
        return np.array([min(int(t), _LONG) for t in (y * y).sum(axis=1)], np.int64)


def integer_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the vectors that take part, and their dimension (0: none)."""
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(column).alias("c")).where(finite(F.col("c")) & (F.size("c") > 0))
    dims = rows.groupBy(F.size("c").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if dims is None:
        return rows.select("vec_id", integer_entries(F.col("c")).alias("x")), 0
    return rows.where(F.size("c") == dims["dim"]).select("vec_id", integer_entries(F.col("c")).alias("x")), dims["dim"]


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """Learned from the distinct vectors ``x`` of rows."""
    distinct = materialise(rows.select("x").distinct(), "fit")
    n, sums = _sums(distinct, dim)
    v = _covariance(distinct, n, sums)
    values, vectors = refined_eigenvectors(v)
    values, vectors = values[:components], vectors[:, :components]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1, 1)
    live = values > FLAT * max(values.max(initial=0), 0)
    axes = np.where(live, vectors / np.sqrt(np.where(live, values, 1)), 0).astype(np.float64)
    trace = np.trace(v)
    explained = (np.where(live, values, 0) / trace if trace > 0 else np.zeros(len(values))).astype(np.float64)
    model = Whitening(n, sums, values.astype(np.float64), axes, explained, 0.0)
    model.identity_error = _identity_error(distinct, model, live)
    return model


def _identity_error(distinct: DataFrame, model: Whitening, live: np.ndarray) -> float:
    """Largest absolute entry of the covariance of the whitened fit list less the identity, measured on the rows."""
    k = len(live)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                z = model.apply(batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1))
                total, sums = total + z.T @ z, sums + z.sum(axis=0)
        values = [int(t * FINE) for t in (*total.ravel().tolist(), *sums.tolist())]  # integers add up the same in any order
        yield _cells(dict(enumerate(values)))

    got = _added(distinct.select("x").mapInArrow(rows, CELLS), dict)
    flat = np.array([got.get(c, 0) / FINE for c in range(k * k + k)]) / model.n
    error = flat[:k * k].reshape(k, k) - np.outer(flat[k * k:], flat[k * k:]) - np.eye(k)
    return float(np.abs(error[np.ix_(live, live)]).max(initial=0.0))


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened array<double>) of the rows of ``integer_vectors``."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.axes.shape[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            z = model.apply(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * k, pa.int32()), pa.array(z.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.deviation(x), pa.int64()), lists], names=["vec_id", "deviation", "whitened"])

    kind = dict(rows.dtypes)["vec_id"]
    return rows.select("vec_id", "x").mapInArrow(apply, f"vec_id {kind}, deviation long, whitened array<double>")


def whiten(vectors: DataFrame, *, components: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per vector that takes part and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    rows, dim = integer_vectors(vectors, id_column, column)
    kind = dict(rows.dtypes)["vec_id"]
    if not dim:
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    model = fit(rows, dim, components)
    share = F.array(*[F.lit(float(e)) for e in model.explained])
    out = whitened(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                      F.element_at(share, (F.col("at") + 1).cast("int")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
