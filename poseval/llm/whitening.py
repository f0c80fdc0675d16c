"""Whitening of embedding vectors by shifted Cholesky QR.

The centred rows A (n x d) are never gathered. Each pass sums the Gram matrix of
the current rows, factors it on the driver (d x d numbers) and goes on with the
rows after a triangular solve. The first pass adds a shift, so its factor exists
however close to singular A is; the next ones orthogonalise what is left. The
product R of the factors satisfies A = Q R, and the singular values and right
vectors of R are those of A, found without squaring the condition number.

Sums go through two levels: tasks first meet in salted groups of lines of the
matrix, then per line, so no task gets a row from every other task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poseval.schema import require_columns

#: Vectors become whole numbers: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Passes at most, Gram entries' distance from the identity that ends them, and
#: the share of the largest singular value below which a direction counts as empty.
PASSES, CLOSE, EMPTY = 5, 1e-10, 1e-9
#: Groups in which the tasks' sums of one line meet first.
FAN = 64


class Whitening(NamedTuple):
    """What was fitted: counts, exact sums, and one column of ``vectors`` per component."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def _usable(df: DataFrame, vector: str, *more: str) -> DataFrame:
    """``more`` and ``v``, the vectors without null or non-finite entries, as doubles."""
    require_columns(df, [vector, *more])
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(more)], F.col(vector).cast("array<double>").alias("v"))
    return rows.where(F.coalesce(fine, F.lit(False)) & (F.size("v") > 0))


def _whole(entries: np.ndarray) -> np.ndarray:
    scaled = np.floor(SCALE * entries)
    if len(scaled) and np.abs(scaled).max() > 2**52:
        raise ValueError("a vector entry is too large to be scaled exactly")
    return scaled.astype(np.int64) + OFFSET


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return _whole(column.flatten().to_numpy(zero_copy_only=False)).reshape(-1, d)


def _solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """X with ``X @ factor == rows`` for an upper triangular factor."""
    out = np.empty_like(rows)
    for j in range(factor.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


_PARTIAL = "line long, salt int, sums binary"


def _partial(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A task's sums as rows, salted by its number."""
    salt = TaskContext.get().partitionId() % FAN
    if found:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array([salt] * len(found), pa.int32()), pa.array([v.tobytes() for v in found.values()], pa.binary())],
            names=["line", "salt", "sums"],
        )


def _total(partial: DataFrame, kind: type) -> dict[int, np.ndarray]:
    """Sums by line. One row per line of the matrix comes to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for line, sums in zip(b.column(0).to_pylist(), b.column(2)):
                values = np.frombuffer(sums.as_buffer(), kind)
                found[line] = found[line] + values if line in found else values
        yield from _partial(found)

    salted = partial.repartition("line", "salt").mapInArrow(add, _PARTIAL)
    rows = salted.repartition("line").mapInArrow(add, _PARTIAL).collect()
    return {r["line"]: np.frombuffer(bytes(r["sums"]), kind) for r in rows}


def _counts(rows: DataFrame) -> dict[int, np.ndarray]:
    """By length of vector: their number, then the sums of their entries, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            sizes = np.diff(b.column(0).offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                x = _matrix(b.column(0).filter(pa.array(sizes == d)), d)
                found[d] = found.get(d, 0) + np.concatenate([[len(x)], x.sum(axis=0)])
        yield from _partial(found)

    return _total(rows.select("v").mapInArrow(run, _PARTIAL), np.int64)


def _gram(rows: DataFrame, width: int, shape: Callable[[pa.ListArray], np.ndarray]) -> np.ndarray:
    """Sum of XᵀX over the rows X that ``shape`` makes of a batch of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            x = shape(b.column(0))
            total += x.T @ x
        yield from _partial(dict(enumerate(total)))

    lines = _total(rows.select("v").mapInArrow(run, _PARTIAL), np.float64)
    return np.stack([lines.get(i, np.zeros(width)) for i in range(width)])


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular R with RᵀR = gram; shifted where it has to be."""
    share = shift * np.trace(gram) * np.eye(len(gram))
    return np.linalg.cholesky(gram + share).T


def _root(gram: np.ndarray) -> np.ndarray:
    """A square factor of a Gram matrix that may be singular."""
    try:
        return _factor(gram, 0.0)
    except np.linalg.LinAlgError:
        values, vectors = np.linalg.eigh(gram)
        return np.sqrt(np.maximum(values, 0))[:, None] * vectors.T


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = 32) -> Whitening | None:
    """Components of the vectors' covariance (divisor n), by falling eigenvalue.

    Vectors that are null, empty or hold null or non-finite entries are left
    out, as are those of another length than most have (of equally frequent
    lengths, the greatest); copies count each. Directions without variance give
    no component, so there may be fewer than ``components``. Each component's
    largest entry is positive. Without any vector the result is None. The
    driver holds d x d numbers, which do not grow with the rows.
    """
    rows = _usable(df, vector)
    counts = _counts(rows)
    if not counts:
        return None
    d = max(counts, key=lambda k: (counts[k][0], k))
    n, sums = int(counts[d][0]), counts[d][1:]
    rows = rows.where(F.size("v") == d)

    def centred(column: pa.ListArray) -> np.ndarray:
        return (n * _matrix(column, d) - sums) / n

    factors: list[np.ndarray] = []

    def current(column: pa.ListArray) -> np.ndarray:
        x = centred(column)
        for factor in factors:
            x = _solve(x, factor)
        return x

    # What rounding may take from the smallest eigenvalue of a sum of n products.
    shift = min(11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2, 1e-6)
    gram = _gram(rows, d, current)
    scale = np.trace(gram)
    while scale > 0 and len(factors) < PASSES and (not factors or np.abs(gram - np.eye(d)).max() > CLOSE):
        try:
            factor = _factor(gram, 0.0 if factors else shift)
        except np.linalg.LinAlgError:
            factor = _factor(gram, shift)
        factors.append(factor)
        gram = _gram(rows, d, current)
    whole = _root(gram)
    for factor in reversed(factors):
        whole = whole @ factor
    _, values, vectors = np.linalg.svd(whole)
    kept = min(components, int((values > EMPTY * values[0]).sum())) if values[0] > 0 else 0
    vectors = vectors[:kept].T
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)])
    eigen = values**2 / n
    scaled = vectors / np.sqrt(eigen[:kept])

    def whitened(column: pa.ListArray) -> np.ndarray:
        w = centred(column) @ scaled
        return np.hstack([w, np.ones((len(w), 1))])

    error = 0.0
    if kept:
        found = _gram(rows, kept + 1, whitened) / n
        mean = found[kept, :kept]
        error = float(np.abs(found[:kept, :kept] - np.outer(mean, mean) - np.eye(kept)).max())
    return Whitening(n, sums, vectors, eigen[:kept], eigen[:kept] / eigen.sum() if kept else eigen[:0], error)


def whiten(df: DataFrame, fit: Whitening, vector: str = "embedding", key: str = "vec_id", deviations: bool = False) -> DataFrame:
    """``key, whitened``: each vector's coordinates on the fitted components, of unit variance.

    The vectors left out of a fit are left out here, too; a null key is kept
    and repeated rows stay. ``deviations`` adds ``deviation``, the exact sum of
    (n * x - sum) squared over the dimensions; it stops where that number does
    not fit 64 bits, as it must from about 10^9 vectors on.
    """
    d, n, sums, scaled = len(fit.sums), fit.n, fit.sums, fit.vectors / np.sqrt(fit.values)
    rows = _usable(df, vector, key).where(F.size("v") == d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off = n * _matrix(b.column(1), d) - sums
            w = (off / n) @ scaled
            ends = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
            out = [b.column(0), pa.ListArray.from_arrays(ends, pa.array(w.reshape(-1)))]
            if deviations:
                if len(off) and (off.astype(float) ** 2).sum(axis=1).max() > 2.0**62:
                    raise OverflowError("the deviation of a vector does not fit 64 bits")
                out.append(pa.array((off * off).sum(axis=1)))
            yield pa.RecordBatch.from_arrays(out, names=["key", "whitened", "deviation"][: len(out)])

    kind = df.schema[key].dataType.simpleString()
    found = rows.mapInArrow(run, f"key {kind}, whitened array<double>" + ", deviation long" * deviations)
    return found.withColumnRenamed("key", key)
