"""Whitening of embeddings: leading eigenpairs of their covariance by spectrum slicing.

Sums and centred products are taken by tasks and added by Spark; only one dimension x dimension matrix reaches the driver. There the number of
eigenvalues above a shift is the number of positive pivots in an LDLᵀ factorisation of the shifted covariance (Sylvester's
law of inertia). Such counts halve intervals until each holds one leading eigenvalue, Rayleigh quotient iteration then converges
cubically to its vector, and counts beside the result certify its number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import bound_batches, written

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
ROWS = 4096
_EPS = np.finfo(np.float64).eps


# --- spectrum slicing on the driver: a matrix whose size does not depend on the rows ---------------


def inertia_above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of the symmetric ``matrix`` above ``shift``, from the pivots of LDLᵀ.

    Pivots are chosen as Bunch and Kaufman do, one row or two at a time, so that the factors stay bounded. A pivot of
    zero counts as not above.
    """
    a = matrix - shift * np.eye(len(matrix))
    alpha, above = (1 + 17**0.5) / 8, 0
    tiny = _EPS * _EPS * max(1e-300, float(np.abs(matrix).max(initial=0)))
    while len(a):
        n = len(a)
        if n == 1:
            return above + int(a[0, 0] > 0)
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1
        largest = column[r - 1]
        size, swap = 1, 0
        if max(abs(a[0, 0]), largest) <= tiny:
            a = a[1:, 1:]
            continue
        if abs(a[0, 0]) < alpha * largest:
            others = np.abs(a[r])
            others[r] = 0
            sigma = others.max()
            if abs(a[0, 0]) * sigma < alpha * largest * largest:
                if abs(a[r, r]) >= alpha * sigma:
                    swap = r
                else:
                    size = 2
                    if r != 1:
                        a[[1, r]] = a[[r, 1]]
                        a[:, [1, r]] = a[:, [r, 1]]
        if swap:
            a[[0, swap]] = a[[swap, 0]]
            a[:, [0, swap]] = a[:, [swap, 0]]
        if size == 1:
            pivot = a[0, 0]
            above += int(pivot > 0)
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0]) / pivot
        else:
            above += 1  # a block of two rows has one positive and one negative eigenvalue
            block = a[:2, :2]
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(block, a[:2, 2:])
        a = (a + a.T) / 2
    return above


class _Counts:
    """Inertia counts already taken, by shift; what one eigenvalue's search learns the next one uses."""

    def __init__(self, matrix: np.ndarray, low: float, high: float):
        self.matrix, self.known = matrix, {low: len(matrix), high: 0}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = inertia_above(self.matrix, shift)
        return self.known[shift]

    def interval(self, k: int) -> tuple[float, float]:
        """The narrowest known (low, high] that holds the eigenvalue of number ``k`` from above."""
        return max(s for s, n in self.known.items() if n >= k), min(s for s, n in self.known.items() if n < k)


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors as columns.

    Equal eigenvalues, or such that cannot be told apart in double precision, share an interval; their vectors are
    made orthogonal. A pair is taken only where the counts on both sides of it confirm its number.
    """
    n = len(matrix)
    k = min(k, n)
    if not n or not np.abs(matrix).max():
        return np.zeros(k), np.eye(n)[:, :k]
    radius = float(np.abs(matrix).sum(axis=1).max())  # Gershgorin
    tight = 8 * n * _EPS * radius
    counts = _Counts(matrix, -radius - tight, radius + tight)
    random = np.random.default_rng(0)
    values, vectors = np.zeros(k), np.zeros((n, k))
    for i in range(k):
        low, high = counts.interval(i + 1)
        while counts.above(low) - counts.above(high) > 1 and high - low > tight:
            middle = (low + high) / 2
            if counts.above(middle) >= i + 1:
                low = middle
            else:
                high = middle
        found = vectors[:, :i]
        for _ in range(60):
            value, vector = _rayleigh(matrix, low, high, found, random, tight)
            if vector is not None and counts.above(value - 2 * tight) > i >= counts.above(value + 2 * tight):
                break  # the counts beside it certify its number
            middle = (low + high) / 2
            low, high = (middle, high) if counts.above(middle) >= i + 1 else (low, middle)
        else:
            raise RuntimeError(f"the counts confirm no eigenvector of number {i + 1}")
        values[i], vectors[:, i] = value, vector
    order = np.argsort(-values, kind="stable")  # equal eigenvalues may come in any order
    return values[order], vectors[:, order]


def _rayleigh(matrix: np.ndarray, low: float, high: float, found: np.ndarray, random: np.random.Generator, tight: float):
    """An eigenpair inside (low, high] whose vector is orthogonal to ``found``, or none if the iteration leaves the interval.

    Two steps of inverse iteration from the middle turn towards the interval's own vector, then the shift follows the
    Rayleigh quotient.
    """
    n, shift = len(matrix), (low + high) / 2

    def orthogonal(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - found @ (found.T @ x)
        return x / np.linalg.norm(x)

    x = orthogonal(random.standard_normal(n))
    best = None
    for step in range(40):
        try:
            y = np.linalg.solve(matrix - shift * np.eye(n), x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(matrix - (shift + tight) * np.eye(n), x)
        if not np.isfinite(y).all():
            break
        x = orthogonal(y / np.abs(y).max())
        value = float(x @ matrix @ x)
        residual = float(np.linalg.norm(matrix @ x - value * x))
        if best is None or residual < best[0]:
            best = (residual, value, x)
        elif step > 6:
            break
        if step >= 2:
            shift = value
            if residual <= tight / 8:
                break
    if best is None or best[0] > 4 * tight or not low - tight <= best[1] <= high + tight:
        return None, None
    return best[1], best[2]


# --- sums, products and projections in tasks --------------------------------------------------------


def valid(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def quantised(vector: Column) -> Column:
    """``floor(64 * c) + 1000000`` of every entry as a long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(OFFSET).cast("long"))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _summed(df: DataFrame, per_chunk: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum over all rows of what ``per_chunk`` makes of runs of vectors: one partial per task, added by Spark, entry by entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in _chunks(batches):
            part = per_chunk(_matrix(batch.column(0)))
            total = part if total is None else total + part
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["place", "part"])

    rows = df.mapInArrow(run, f"place long, part {kind}").groupBy("place").agg(F.sum("part").alias("total")).collect()
    out = np.zeros(len(rows), np.int64 if kind == "long" else np.float64)
    for r in rows:
        out[r.place] = r.total
    return out


@dataclass
class Whitening:
    """What whitens a row: fitted on ``n`` vectors, a few hundred KB whatever the corpus."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def positive(self) -> np.ndarray:
        """Components with a variance beyond rounding; others cannot be whitened."""
        return self.values > 16 * len(self.sums) * _EPS * self.trace

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact."""
        return x * self.n - self.sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        scale = np.where(self.positive, np.sqrt(np.maximum(self.values, 0)), np.nan)
        return (self.deviations(x) / self.n) @ self.vectors / scale


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit on all rows of ``vectors``, whose first column is the quantised vector.

    Three passes: counts and exact sums, products of the centred vectors, and the covariance of the whitened
    vectors themselves, for ``identity_error``. No rows give a fit of no dimension. Vectors of different lengths raise ``ValueError``, and so do
    values whose sums do not fit 64 bits.
    """
    x, size = F.col(vectors.columns[0]), F.size(vectors.columns[0])
    n, least, dimension, largest = vectors.agg(F.count(F.lit(1)), F.min(size), F.max(size), F.max(F.array_max(F.transform(x, F.abs)))).first()
    if not n:
        return Whitening(0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)), 0.0)
    if least != dimension:
        raise ValueError(f"vectors have {least} to {dimension} entries")
    if n * largest >= 1 << 62:
        raise ValueError("sums of the entries do not fit 64 bits")
    only = vectors.select(x)
    sums = _summed(only, lambda x: x.sum(axis=0), "long")

    def products(x: np.ndarray) -> np.ndarray:
        centred = (x * n - sums) / n
        return centred.T @ centred

    covariance = _summed(only, products).reshape(dimension, dimension) / n
    covariance = (covariance + covariance.T) / 2
    values, basis = leading_eigenpairs(covariance, components)
    model = Whitening(n, sums, values, basis, float(np.trace(covariance)))
    use = model.positive
    if use.any():

        def moments(x: np.ndarray) -> np.ndarray:
            w = model.whitened(x)[:, use]
            return np.vstack([w.T @ w, w.sum(axis=0)])

        k = int(use.sum())
        sums_ = _summed(only, moments).reshape(k + 1, k) / n
        model.identity_error = float(np.abs(sums_[:k] - np.outer(sums_[k], sums_[k]) - np.eye(k)).max())
    return model


def quantised_rows(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(x, key)`` of the rows with a valid vector, written to the shared folder: it is read four times."""
    valued = df.filter(valid(F.col(vector))).select(quantised(F.col(vector)).alias("x"), F.col(key).alias("key"))
    return written(valued, "vectors")


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(key, n, deviation, whitened, explained, identity_error)`` per row with a valid vector.

    Rows without a vector, with an empty one, or with a NULL or non-finite entry are dropped; rows that repeat and NULL keys stay. ``deviation`` is
    decimal(38,0) and exact. ``whitened`` and ``explained`` are arrays with one value per component, the least of ``components`` and the
    dimension; a component without variance has a NULL and 0 there. Equal eigenvalues get any orthogonal vectors, the same
    for all rows. An empty table gives an empty result; other columns are not read, whatever their names.
    """
    rows = quantised_rows(df, key, vector)
    model = fit(rows, components)
    explained = [float(v) if p else 0.0 for v, p in zip(model.values / (model.trace or 1.0), model.positive, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            x = _matrix(batch.column(0))
            deviations = model.deviations(x)
            exact = deviations.astype(object) if np.abs(deviations).max() >= 1 << 28 else deviations
            squares = [int(v) for v in (exact * exact).sum(axis=1)]
            w = model.whitened(x)
            flat = pa.array(w.ravel(), mask=np.isnan(w.ravel()))
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(map(str, squares), pa.string()), pa.ListArray.from_arrays(offsets, flat)],
                names=["key", "deviation", "whitened"],
            )

    bound_batches(df.sparkSession)
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, deviation string, whitened array<double>")
    return out.select(
        F.col("key").alias(key),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened",
        F.array(*map(F.lit, explained)).cast("array<double>").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
