"""Whitening of embeddings: exact integer sums, a centred covariance, and its leading components by spectrum slicing.

Tasks sum the vectors and their centred products; one number for each pair of dimensions comes to the driver. There the
covariance is reduced to a tridiagonal matrix once. The LDLᵀ factors of that matrix, shifted, count the eigenvalues above
the shift (Sylvester's law of inertia). Bisection on these counts isolates each leading eigenvalue, Rayleigh quotient
iteration on the covariance itself refines it, and the counts on both sides of the result certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import record_batch, share
from weftline.session import materialize

#: Entries are held in steps of 1/64 above this offset.
STEPS, OFFSET = 64, 1_000_000
#: floor(64 c) beyond this, where doubles have no neighbours one apart, is held at it.
LARGEST = 1 << 52
COMPONENTS = 32
_ROWS = 2048
_LOW_BITS = 26
_EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Whitening:
    """Vectors of the fit, their sums, the integer part and rest of their means, and the scaled components (dims x k)."""

    n: int
    sums: list[int]
    centre: np.ndarray
    rest: np.ndarray
    weights: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre).astype(np.float64) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.weights

    def with_ones(self, x: np.ndarray) -> np.ndarray:
        """Whitened vectors and a column of ones, whose products are sums."""
        return np.hstack([self.whitened(x), np.ones((len(x), 1))])

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums over dimensions of (n x - S)², exact; null where a long can't hold it."""
        y = x - self.centre
        remainder = [s - self.n * int(c) for s, c in zip(self.sums, self.centre, strict=True)]
        reach = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if x.shape[1] * reach * reach < 1 << 63:
            z = self.n * y - np.array(remainder, np.int64)
            return pa.array((z * z).sum(axis=1), pa.int64())
        z = self.n * y.astype(object) - np.array(remainder, object)
        exact = (z * z).sum(axis=1)
        return pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())


def _vectors(column: pa.Array, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the column and x-vectors (a row each) of its whole finite vectors, by their length, or of one length."""
    lists = column.cast(pa.large_list(pa.float64()))
    values = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(values))])  # a null entry is not a number here
    whole = (lengths > 0) & (broken[ends] == broken[ends - lengths])
    for length in np.unique(lengths[whole]) if size is None else [size]:
        rows = np.flatnonzero(whole & (lengths == length))
        for low in range(0, len(rows), _ROWS):
            part = rows[low : low + _ROWS]
            picked = values[(ends[part] - length)[:, None] + np.arange(length)]
            yield part, np.clip(np.floor(STEPS * picked), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def _sums(vectors: DataFrame) -> DataFrame:
    """size, place, n, high, low: counts and sums by vector length and dimension; the sum is high * 2^26 + low."""
    schema = pa.schema([(c, pa.int64()) for c in ("size", "place", "n", "high", "low")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _vectors(batch.column(0)):
                size = x.shape[1]
                total = held.setdefault(size, np.zeros((3, size), np.int64))
                total[0] += len(x)
                total[1] += (x >> _LOW_BITS).sum(axis=0)
                total[2] += (x & ((1 << _LOW_BITS) - 1)).sum(axis=0)
        for size, total in held.items():
            yield record_batch(schema, np.full(size, size), np.arange(size), *total)

    parts = vectors.mapInArrow(task, "size long, place long, n long, high long, low long")
    return parts.groupBy("size", "place").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")])


def _products(vectors: DataFrame, size: int, rows_of, k: int) -> np.ndarray:
    """Sums over all vectors of the products of each two of the k numbers that `rows_of` makes of a vector."""
    given = share(vectors.sparkSession, rows_of)
    schema = pa.schema([("one", pa.int32()), ("other", pa.int32()), ("total", pa.float64())])
    one, other = np.triu_indices(k)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            for _, x in _vectors(batch.column(0), size):
                rows = given.value(x)
                total += rows.T @ rows
        yield record_batch(schema, one.astype(np.int32), other.astype(np.int32), total[one, other])

    parts = vectors.mapInArrow(task, "one int, other int, total double").groupBy("one", "other").agg(F.sum("total").alias("total"))
    cells = parts.toArrow()  # one row for each pair of dimensions
    out = np.zeros((k, k))
    out[cells["one"].to_numpy(), cells["other"].to_numpy()] = cells["total"].to_numpy()
    return np.triu(out) + np.triu(out, 1).T


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of a symmetric one (Householder)."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        norm = np.linalg.norm(v)
        if norm == 0.0:
            continue
        lead = -np.copysign(norm, v[0])
        v[0] -= lead
        v /= np.linalg.norm(v)
        block = a[k + 1 :, k + 1 :]
        p = block @ v
        p -= (v @ p) * v
        block -= 2 * (np.outer(v, p) + np.outer(p, v))
        a[k + 1 :, k] = a[k, k + 1 :] = 0.0
        a[k + 1, k] = a[k, k + 1] = lead
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues above each shift: the positive pivots of LDLᵀ of the shifted tridiagonal matrix."""
    tiny = max(np.finfo(float).tiny / _EPS, float(np.max(off * off, initial=0.0)) * np.finfo(float).tiny)
    pivot = diagonal[0] - shifts
    counts = np.zeros(len(shifts), np.int64)
    for k in range(len(diagonal)):
        if k:
            pivot = diagonal[k] - shifts - off[k - 1] ** 2 / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        counts += pivot > 0
    return counts


def _slices(diagonal: np.ndarray, off: np.ndarray, k: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Intervals (low, high] of the k leading eigenvalues, as narrow as the counts can tell them apart."""
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low = np.full(k, (diagonal - reach).min() - scale * 1e-8)
    high = np.full(k, (diagonal + reach).max() + scale * 1e-8)
    number = np.arange(1, k + 1)
    for _ in range(200):
        middle = (low + high) / 2
        wide = (high - low > 4 * _EPS * scale) & (middle > low) & (middle < high)
        if not wide.any():
            break
        above = count_above(diagonal, off, middle)
        low = np.where(wide & (above >= number), middle, low)
        high = np.where(wide & (above < number), middle, high)
    return low, high


def _solved(a: np.ndarray, shift: float, b: np.ndarray, scale: float) -> np.ndarray:
    """(a - shift)⁻¹ b, with the shift moved a little where it is an eigenvalue to the last bit."""
    for step in range(8):
        try:
            out = np.linalg.solve(a - (shift + step * 2 * _EPS * scale) * np.eye(len(a)), b)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(out).all():
            return out
    raise ArithmeticError("no shifted system could be solved")


def leading_pairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest positive eigenvalues of a symmetric matrix, falling, and their unit vectors as columns.

    Fewer come where the rest is zero to working precision. Eigenvalues closer than the counts can tell apart are
    found together as one subspace, of which any orthonormal basis is right.
    """
    n = len(a)
    scale = float(np.abs(a).sum(axis=1).max(initial=0.0))
    if scale == 0.0:
        return np.empty(0), np.empty((n, 0))
    diagonal, off = tridiagonal(a)
    k = min(k, n)
    noise = 8 * n * _EPS * scale
    k = min(k, int(count_above(diagonal, off, np.array([noise]))[0]))
    low, high = _slices(diagonal, off, min(n, k + 1), scale)
    middle = (low + high) / 2
    values, vectors = np.zeros(k), np.zeros((n, k))
    random = np.random.default_rng(7)
    done = 0
    while done < k:
        # Neighbours within a cluster are refined together: their vectors are only defined as a subspace.
        size = 1
        while done + size < len(middle) and middle[done + size - 1] - middle[done + size] <= 64 * noise:
            size += 1
        if size > 1:  # a cluster may go on below the k-th
            size = int(count_above(diagonal, off, np.array([middle[done + size - 1] - noise]))[0]) - done
        found = vectors[:, :done]
        block = random.standard_normal((n, size))
        shift = middle[done : done + size].mean()
        for _ in range(3):
            block -= found @ (found.T @ block)
            block = np.linalg.qr(_solved(a, shift, block, scale))[0]
            block -= found @ (found.T @ block)
            block = np.linalg.qr(block)[0]
        if size == 1:
            v = block[:, 0]
            for _ in range(10):
                rho = v @ a @ v
                if np.linalg.norm(a @ v - rho * v) <= 2 * _EPS * scale:
                    break
                v = _solved(a, rho, v, scale)
                v -= found @ (found.T @ v)
                v /= np.linalg.norm(v)
            block, rho = v[:, None], np.array([v @ a @ v])
        else:
            rho, turn = np.linalg.eigh(block.T @ a @ block)
            block, rho = block @ turn[:, ::-1], rho[::-1]
        above = count_above(diagonal, off, np.array([rho[0] + noise, rho[-1] - noise]))
        if above[0] > done or above[1] < min(n, done + size):
            raise ArithmeticError(f"component {done + 1} is not certified by the counts")
        take = min(size, k - done)
        values[done : done + take], vectors[:, done : done + take] = rho[:take], block[:, :take]
        done += take
    return values, vectors


def fit(embeddings: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all whole finite vectors of the column `embedding`; None if no direction has any variance."""
    vectors = embeddings.select("embedding")
    sums = materialize(_sums(vectors), "vector-sums")
    most = sums.filter("place = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return None
    size, n = most["size"], most["n"]
    cells = sums.filter(F.col("size") == size).orderBy("place").collect()  # one row for each dimension
    totals = [(row["high"] << _LOW_BITS) + row["low"] for row in cells]
    centre = np.array([s // n for s in totals], np.int64)
    rest = np.array([(s % n) / n for s in totals])
    plain = Whitening(n, totals, centre, rest, np.empty((size, 0)), np.empty(0))
    covariance = _products(vectors, size, plain.centred, size) / n
    values, found = leading_pairs(covariance, components)
    if not len(values):
        return None
    return Whitening(n, totals, centre, rest, found / np.sqrt(values), values / np.trace(covariance))


def identity_error(embeddings: DataFrame, whitening: Whitening) -> float:
    """The largest absolute entry of the covariance of all whitened vectors minus the identity."""
    k = whitening.weights.shape[1]
    products = _products(embeddings.select("embedding"), len(whitening.centre), whitening.with_ones, k + 1)
    mean = products[:k, k] / products[k, k]
    return float(np.abs(products[:k, :k] / products[k, k] - np.outer(mean, mean) - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component.

    `embeddings` has vec_id, handed on as it is (nulls and repeated ids too), and embedding; other columns are not read. A
    vector that is null, empty, or holds a null or non-finite entry has no row and no part in the fit. Vectors have the
    length that most have (the longest of these, if several); those of another length are left out like broken ones.
    Equal vectors have equal rows. Directions without variance to working precision give no component, so
    equal vectors alone, a single one, or an empty table give no rows.
    """
    spark = embeddings.sparkSession
    kind = embeddings.schema["vec_id"].dataType
    out = T.StructType([
        T.StructField("vec_id", kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ])
    whitening = fit(embeddings, components)
    if whitening is None:
        return spark.createDataFrame([], out)
    given = share(spark, (whitening, identity_error(embeddings, whitening)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whitening, error = given.value
        k = whitening.weights.shape[1]
        for batch in batches:
            for rows, x in _vectors(batch.column(1), len(whitening.centre)):
                cells = len(x) * k
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows[each])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(cells, whitening.n, np.int64)),
                        whitening.deviations(x).take(pa.array(each)),
                        pa.array(whitening.whitened(x).ravel()),
                        pa.array(np.tile(whitening.explained, len(x))),
                        pa.array(np.full(cells, error)),
                    ],
                    names=out.names,
                )

    return embeddings.select("vec_id", "embedding").mapInArrow(task, out)
