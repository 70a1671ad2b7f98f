"""Embedding whitening: principal components from a pivoted Cholesky factor and one-sided Jacobi rotations.

Entries become whole numbers, ``floor(256 * c)``. Every different vector counts once in the fit, however
often it is repeated. Number and sums of the fit list are exact; the scatter is the sum of the products
of centred vectors, made per partition and added up. Its factor is decomposed without forming another
matrix: the scatter is L L^T with L from pivoted Cholesky, rotations from the right make the columns of
L orthogonal, and then their squared lengths are the eigenvalues and their directions the components.

Edge cases: a vector is dropped (its results are null) if it is null or empty, holds null, NaN or
infinite entries or entries whose 256-fold is beyond 64 bits, or has another length than most
different vectors have (ties: the greater length). Directions without any spread have no component, so
a table of one vector, repeated or not, has none, and neither has an empty table. A ``deviation`` beyond
64 bits is null. Null ids and repeated rows keep their rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import SLICE_ROWS, append, column, summed, tidy
from millrace.session import stage

SCALE = 256.0
#: Sweeps of rotations; a handful do, as the factor's columns come in falling order.
SWEEPS = 60
_HALF = 32


class Whitening(NamedTuple):
    """What rows are projected with. ``components`` has one column per component, by falling eigenvalue."""

    size: int
    total: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.eigenvalues]


def whole_vectors(vectors: pa.Array) -> tuple[list[np.ndarray | None], np.ndarray]:
    """Per row its whole numbers, or None for a row to drop; and the lengths, 0 for such a row."""
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    scaled = pc.cast(vectors.flatten(), pa.float64()).to_numpy(zero_copy_only=False) * SCALE
    good = np.abs(scaled) < 2.0 ** 63  # not true of NaN, which nulls have become
    parent = np.repeat(np.arange(len(sizes)), sizes)
    kept = (np.bincount(parent[~good], minlength=len(sizes)) == 0) & (sizes > 0)
    numbers = np.floor(np.where(good, scaled, 0)).astype(np.int64)
    stops = np.cumsum(sizes)
    rows = [numbers[b - n:b] if k else None for k, b, n in zip(kept.tolist(), stops.tolist(), sizes.tolist(), strict=True)]
    return rows, np.where(kept, sizes, 0)


def _written(vector: np.ndarray) -> bytes:
    """The one way to write a vector: the narrowest of three widths, told by the first byte."""
    for width in ("<i2", "<i4", "<i8"):
        narrow = vector.astype(width)
        if (narrow == vector).all():
            return width[-1].encode() + narrow.tobytes()
    raise AssertionError("eight bytes hold any whole number")


def _read(code: bytes) -> np.ndarray:
    return np.frombuffer(code, f"<i{chr(code[0])}", offset=1).astype(np.int64)


def _matrices(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, len(batch), SLICE_ROWS):
            codes = batch.column("code").slice(at, SLICE_ROWS).to_pylist()
            yield np.stack([_read(c) for c in codes]).reshape(-1, dimension)


def fit_list(df: DataFrame, vectors: str) -> DataFrame:
    """``dimension`` and ``code`` of every different vector that can be used."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE_ROWS):
                rows, sizes = whole_vectors(batch.column(0).slice(at, SLICE_ROWS))
                codes = [_written(r) for r in rows if r is not None]
                yield pa.RecordBatch.from_arrays([pa.array(sizes[sizes > 0], pa.int32()), pa.array(codes, pa.binary())],
                                                 names=["dimension", "code"])

    return df.select(column(df, vectors)).mapInArrow(tidy(coded), "dimension int, code binary").distinct()


def _sums(codes: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each entry, exactly: numbers are added in two halves."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dimension, np.int64), np.zeros(dimension, np.int64)
        for x in _matrices(batches, dimension):
            n += len(x)
            high += (x >> _HALF).sum(axis=0)
            low += (x & (1 << _HALF) - 1).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dimension), pa.int32()), pa.array([n] * dimension, pa.int64()), pa.array(high), pa.array(low)],
                names=["place", "n", "high", "low"])

    parts = codes.mapInArrow(tidy(partial), "place int, n long, high long, low long")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    rows = sorted(parts.groupBy("place").agg(*wide).collect())
    return int(rows[0].n), [(int(r.high) << _HALF) + int(r.low) for r in rows]


def offsets(x: np.ndarray, size: int, total: list[int]) -> np.ndarray:
    """``size * x - total``, exactly: as 64-bit numbers where they suffice, else as Python's."""
    largest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if size * largest + max(map(abs, total), default=0) < 1 << 62:
        return x * size - np.array(total, np.int64)
    return x.astype(object) * size - np.array(total, object)


def deviations(moved: np.ndarray) -> list[int | None]:
    """Sum of squares of each row of offsets; None beyond 64 bits."""
    rough = (moved.astype(np.float64) ** 2).sum(axis=1)
    if moved.dtype == np.int64 and not (rough >= 2.0 ** 62).any():
        return (moved * moved).sum(axis=1).tolist()
    sums = (sum(v * v for v in map(int, row)) for row in moved)
    return [s if s < 1 << 63 else None for s in sums]


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower triangular L (as many columns as the rank) and an order of rows p with matrix[p][:, p] = L L^T."""
    a, d = matrix.astype(np.float64).copy(), len(matrix)
    order, factor = np.arange(d), np.zeros((d, d))
    least = a.diagonal().max(initial=0) * d * np.finfo(float).eps
    for k in range(d):
        pivot = k + int(np.argmax(a.diagonal()[k:]))
        if a[pivot, pivot] <= least:
            return factor[:, :k], order
        swap, back = [k, pivot], [pivot, k]
        a[swap], order[swap], factor[swap] = a[back], order[back], factor[back]
        a[:, swap] = a[:, back]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1:, k] = a[k + 1:, k] / factor[k, k]
        a[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every two of n columns meet once, in rounds of pairs that have no column in common."""
    ring = np.arange(n + n % 2)
    for _ in range(len(ring) - 1):
        p, q = ring[:len(ring) // 2], ring[::-1][:len(ring) // 2]
        real = (p < n) & (q < n)
        yield np.minimum(p, q)[real], np.maximum(p, q)[real]
        ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """The factor after rotations of pairs of its columns that leave all of them orthogonal."""
    w, eps = factor.copy(), np.finfo(float).eps
    for _ in range(SWEEPS):
        worst = 0.0
        for p, q in _rounds(w.shape[1]):
            x, y = w[:, p], w[:, q]
            a, b, g = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            skew = np.abs(g) / np.sqrt(a * b)
            worst = max(worst, float(skew.max(initial=0)))
            turned = skew > eps
            if not turned.any():
                continue
            p, q, x, y = p[turned], q[turned], x[:, turned], y[:, turned]
            zeta = (b[turned] - a[turned]) / (2 * g[turned])
            tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            cosine = 1 / np.hypot(1, tangent)
            w[:, p], w[:, q] = cosine * (x - tangent * y), cosine * (tangent * x + y)
        if worst <= len(w) * eps:
            break
    return w


def principal(scatter: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors (columns) and eigenvalues of a scatter, by falling eigenvalue, ``most`` at most."""
    factor, order = pivoted_cholesky(scatter)
    turned = np.zeros_like(factor)
    turned[order] = orthogonal_columns(factor)
    lengths = np.sqrt((turned * turned).sum(axis=0))
    first = np.argsort(-lengths, kind="stable")[:most]
    vectors = turned[:, first] / lengths[first]
    largest = np.abs(vectors).argmax(axis=0)
    return vectors * np.sign(vectors[largest, range(len(first))]), lengths[first] ** 2


def projected(moved: np.ndarray, size: int, components: np.ndarray, eigenvalues: np.ndarray) -> np.ndarray:
    return (moved / size).astype(np.float64) @ components / np.sqrt(eigenvalues)


def fit(df: DataFrame, vectors: str, most: int = 4) -> Whitening:
    """Learns the first ``most`` components from all different vectors of a column of arrays of numbers.

    Only matrices of dimension times dimension reach the driver, whatever the number of rows.
    """
    listed = stage(fit_list(df, vectors), "vectors")
    common = listed.groupBy("dimension").count().orderBy(F.desc("count"), F.desc("dimension")).first()
    if common is None:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    d = common.dimension
    codes = listed.where(F.col("dimension") == d).select("code")
    size, total = _sums(codes, d)

    def scattered(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((d, d))
        for x in _matrices(batches, d):
            centred = (offsets(x, size, total) / size).astype(np.float64)
            out += centred.T @ centred
        return out.ravel()

    covariance = summed(codes, scattered, d * d).reshape(d, d) / size
    components, eigenvalues = principal(covariance, most)
    k = len(eigenvalues)

    def means(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return sum((projected(offsets(x, size, total), size, components, eigenvalues).sum(axis=0) for x in _matrices(batches, d)),
                   np.zeros(k))

    mean = summed(codes, means, k) / size if k else np.zeros(0)

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((k, k))
        for x in _matrices(batches, d):
            centred = projected(offsets(x, size, total), size, components, eigenvalues) - mean
            out += centred.T @ centred
        return out.ravel()

    spread = summed(codes, products, k * k).reshape(k, k) / size if k else np.zeros((0, 0))
    error = float(np.abs(spread - np.eye(k)).max(initial=0))
    return Whitening(size, total, components, eigenvalues, float(np.trace(covariance)), error)


def whiten(df: DataFrame, vectors: str, model: Whitening, drop: tuple[str, ...] = ()) -> DataFrame:
    """The frame with ``whitened``, the centred vector on each component over the root of its eigenvalue, and ``deviation``.

    ``deviation`` is the sum of ``(n * x - S) ** 2`` over the entries x, where n vectors of the fit add up to S. Both
    are null for a row that is dropped.
    """

    def make():
        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            rows, sizes = whole_vectors(batch.column(vectors))
            fits = np.flatnonzero(sizes == len(model.total)) if model.total else np.empty(0, np.int64)
            whitened: list = [None] * len(rows)
            deviation: list = [None] * len(rows)
            if len(fits):
                moved = offsets(np.stack([rows[i] for i in fits]), model.size, model.total)
                values = projected(moved, model.size, model.components, model.eigenvalues)
                for i, value, far in zip(fits.tolist(), values.tolist(), deviations(moved), strict=True):
                    whitened[i], deviation[i] = value, far
            return [pa.array(whitened, pa.list_(pa.float64())), pa.array(deviation, pa.int64())]

        return work

    return append(df, "whitened array<double>, deviation long", make, drop)
