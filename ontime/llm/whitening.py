"""Embedding whitening with a covariance from squares alone.

Entries become whole numbers, so every sum is exact and does not depend on the order of rows. One pass gives the number of vectors and
each dimension's sum; a second adds up, for each dimension and for each sum of two dimensions, the square of its distance from (the whole part of)
its mean. By polarisation the covariance of two dimensions is half of what the variance of their sum exceeds both their variances by. The driver
corrects the fractions of the means in whole numbers of any size, divides once, and decomposes the d x d matrix. A third pass
whitens and checks its own covariance against the identity; the result whitens again as it is read.

Tasks send d(d + 3)/2 sums each, which add up by pair; the driver gets d(d + 3)/2 numbers, however many vectors there are.

Cases: vectors that are null or hold null, NaN or infinite entries are left out; without any other vector the result is empty. A vector
shorter than the longest counts as filled up with zeros. Entries whose scaled value does not fit 62 bits are held at that bound. Sums too large
for 64 bits are added up as whole numbers of any size. Components without variance (one vector only, equal dimensions) have no
whitened value and are left out, so fewer than asked for may come back. Repeated rows and ids count and are returned each. Extra
columns are never read. Eigenvectors are turned so that their largest entry is positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Rows worked on at a time: numbers below 2**21 can then be squared and summed in 64 bits.
ROWS = 1 << 12
#: Sums travel as two decimals, so that they may exceed one.
LIMB = 10**18
_FITS = 1 << 62


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of the vectors that count."""
    v = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return df.select(F.col(f"`{key}`").alias("id"), v.alias("vector")).where(F.col("vector").isNotNull() & finite)


def _whole(lists: pa.Array, d: int | None = None) -> np.ndarray:
    """floor(scale * entry) of a column of vectors, filled up with zeros to d (or the longest)."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = max(int(sizes.max(initial=0)), 1) if d is None else d
    scaled = np.clip(np.floor(flat * SCALE), -_FITS, _FITS).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return scaled.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = scaled
    return out


def _sum(values: np.ndarray) -> np.ndarray:
    """Exact column sums, as Python's whole numbers where 64 bits could overflow."""
    most = int(np.abs(values).max(initial=0))
    if most * max(len(values), 1) < _FITS:
        return values.sum(0).astype(object)
    return values.astype(object).sum(0)


def _squares(values: np.ndarray) -> np.ndarray:
    """Exact column sums of squares."""
    most = int(np.abs(values).max(initial=0))
    if most * most * max(len(values), 1) < _FITS:
        return np.einsum("ij,ij->j", values, values).astype(object)
    wide = values.astype(object)
    return (wide * wide).sum(0)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


_SUMS = "i int, j int, low decimal(38,0), high decimal(38,0)"


def _sum_rows(sums: dict[tuple[int, int], int]) -> pa.RecordBatch:
    """Rows of (i, j) and the sum in two parts, the lower from 0 to 10**18."""
    kind = pa.decimal128(38, 0)
    low, high = zip(*((int(v) % LIMB, int(v) // LIMB) for v in sums.values())) if sums else ((), ())
    index = [pa.array([k[p] for k in sums], pa.int32()) for p in (0, 1)]
    return pa.RecordBatch.from_arrays([*index, pa.array(low, kind), pa.array(high, kind)], names=["i", "j", "low", "high"])


def _added(df: DataFrame) -> dict[tuple[int, int], int]:
    rows = df.groupBy("i", "j").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).collect()
    return {(r.i, r.j): int(r.low) + int(r.high) * LIMB for r in rows}


def totals(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors, and the sum of scaled entries of each dimension, without the offset."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(0, object)
        for batch in batches:
            for part in _parts(batch):
                more = _sum(_whole(part.column(0)))
                n += part.num_rows
                if len(more) > len(sums):
                    sums = np.concatenate((sums, np.zeros(len(more) - len(sums), object)))
                sums[: len(more)] += more
        if n:
            yield _sum_rows({(-1, -1): n} | {(i, i): v for i, v in enumerate(sums)})

    found = _added(vectors.select("vector").mapInArrow(summed, _SUMS))
    n = found.pop((-1, -1), 0)
    return n, [found[i, i] for i in range(len(found))]


def square_sums(vectors: DataFrame, centre: list[int]) -> dict[tuple[int, int], int]:
    """For i = j the sum of squares of dimension i about its centre, for i < j that of the dimensions' sum about both."""
    d, middle = len(centre), np.array(centre, np.int64)

    def squared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pairs = np.zeros(d, object), [np.zeros(d - i - 1, object) for i in range(d)]
        any_row = False
        for batch in batches:
            for part in _parts(batch):
                any_row = True
                y = _centred(_whole(part.column(0), d), middle)
                own += _squares(y)
                for i in range(d - 1):
                    pairs[i] += _squares(y[:, i + 1 :] + y[:, i : i + 1])
        if any_row:
            found = {(i, i): own[i] for i in range(d)}
            yield _sum_rows(found | {(i, i + 1 + k): v for i in range(d) for k, v in enumerate(pairs[i])})

    return _added(vectors.select("vector").mapInArrow(squared, _SUMS))


def _centred(values: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """Differences in 64 bits where they fit (twice, for sums of two), else as Python's whole numbers."""
    most = int(np.abs(values).max(initial=0)) + int(np.abs(middle).max(initial=0))
    return values - middle if 2 * most < _FITS else values.astype(object) - middle.astype(object)


@dataclass(frozen=True)
class Whitening:
    """All that a row needs: sums and counts, and one column of ``weights`` for each component."""

    n: int
    centre: tuple[int, ...]
    rest: tuple[int, ...]
    weights: np.ndarray
    explained: np.ndarray

    @property
    def sums(self) -> list[int]:
        """Of the entries with their offset."""
        return [self.n * (c + OFFSET) + r for c, r in zip(self.centre, self.rest)]

    def centred(self, lists: pa.Array) -> np.ndarray:
        return _centred(_whole(lists, len(self.centre)), np.array(self.centre, np.int64))

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened values: a column for each component."""
        return (y.astype(np.float64) - np.array(self.rest, np.float64) / self.n) @ self.weights

    def deviations(self, y: np.ndarray) -> list[int]:
        """Exact sum of (n x - S)**2 over the dimensions, for each row."""
        most, d = int(np.abs(y).max(initial=0)), len(self.centre)
        if (self.n * (most + 1)) ** 2 * d < _FITS:
            away = self.n * y.astype(np.int64) - np.array(self.rest, np.int64)
            return np.einsum("ij,ij->i", away, away).tolist()
        wide, rest, n = y.astype(object), np.array(self.rest, object), self.n
        return (n * n * (wide * wide).sum(1) - 2 * n * (wide @ rest) + int((rest * rest).sum())).tolist()


def covariance(n: int, centre: list[int], rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """By polarisation, exactly n**2 times the covariance in whole numbers; divided once at the end."""
    d = len(centre)
    # n * (sum of squares about the centre) - (n times what the mean exceeds it by)**2
    own = [n * squares[i, i] - rest[i] ** 2 for i in range(d)]
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = own[i] / (n * n)
        for j in range(i + 1, d):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n * n)
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """From all ``usable`` vectors; None without any."""
    n, sums = totals(vectors)
    if not n:
        return None
    centre, rest = [s // n for s in sums], [s % n for s in sums]
    v = covariance(n, centre, rest, square_sums(vectors, centre))
    values, turned = np.linalg.eigh(v)
    values, turned = values[::-1], turned[:, ::-1]
    # What rounding alone may leave of a component without variance.
    able = values > max(values[0], 0) * len(v) * 1e-13
    values, turned = values[able][:components], turned[:, able][:, :components]
    largest = turned[np.abs(turned).argmax(0), np.arange(turned.shape[1])] if turned.size else np.ones(0)
    return Whitening(n, tuple(centre), tuple(rest), turned * np.sign(largest) / np.sqrt(values), values / v.trace() if len(values) else values)


def identity_error(vectors: DataFrame, whitening: Whitening) -> float:
    """Largest absolute difference between the covariance of the whitened values and the identity."""
    k = whitening.weights.shape[1]
    if not k:
        return 0.0

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for part in _parts(batch):
                w = whitening.project(whitening.centred(part.column(0)))
                first += w.sum(0)
                second += w.T @ w
        i, j = np.divmod(np.arange(k * k), k)
        i, j = np.concatenate((i, np.arange(k))), np.concatenate((j, np.full(k, -1)))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.concatenate((second.ravel(), first)))], names=["i", "j", "x"])

    rows = vectors.select("vector").mapInArrow(products, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    mean, second = np.zeros(k), np.zeros((k, k))
    for r in rows:
        if r.j < 0:
            mean[r.i] = r.x / whitening.n
        else:
            second[r.i, r.j] = r.x / whitening.n
    # The mean is zero but for rounding, so taking its product off loses no digits.
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    ``deviation`` is a decimal of 38 digits, null where it has more.
    """
    vectors = usable(df, key, vector)
    session = df.sparkSession
    kind = vectors.schema["id"].dataType.simpleString()
    layout = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    whitening = fit(vectors, components)
    if whitening is None:
        return session.createDataFrame([], layout)
    error = identity_error(vectors, whitening)
    k = whitening.weights.shape[1]

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = pa.decimal128(38, 0)
        for batch in batches:
            for part in _parts(batch):
                y, rows = whitening.centred(part.column(1)), part.num_rows
                deviation = pa.array([x if x < 10**38 else None for x in whitening.deviations(y)], decimal)
                index = pa.array(np.repeat(np.arange(rows), k))
                columns = [
                    part.column(0).take(index), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, whitening.n)),
                    deviation.take(index), pa.array(whitening.project(y).ravel()), pa.array(np.tile(whitening.explained, rows)), pa.array(np.full(rows * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(whitened, layout)
