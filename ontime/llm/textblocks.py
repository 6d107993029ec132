"""Numpy views of text columns: bytes, words and hashes of many texts at a time.

A block is a run of rows of one Arrow array, cut by bytes, so that memory is bounded however long or many the rows are (a
single row is never cut). Words are runs of bytes other than 0x20 and 0x09-0x0D; these never occur inside a UTF-8 character,
so bytes and code points agree on word bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A value for each byte, so that the hash isn't a plain polynomial in small numbers.
_BYTE_VALUE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_powers = np.ones(1, _U), np.ones(1, _U)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator: every output bit depends on every input bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers = tuple(np.concatenate(([_U(1)], np.cumprod(np.full(size, b, _U)))) for b in (_BASE, _BASE_INV))
    return _powers[0][:n], _powers[1][:n]


class Rolling:
    """Hash of any run of a sequence in constant time, from prefix sums modulo 2**64."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, _U)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))


@dataclass
class Block:
    """Texts first..first+rows of an array as one run of bytes; text i is data[bounds[i]:bounds[i+1]], empty when null."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def starts_here(self) -> np.ndarray:
        """True where a text begins; one longer than the data."""
        out = np.zeros(len(self.data) + 1, bool)
        out[self.bounds] = True
        return out

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and the row it is in."""
        inside = ~_IS_SPACE[self.data]
        edge = self.starts_here()
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:-1]
        end[:-1] &= ~inside[1:] | edge[1:-1]
        at = np.flatnonzero(start)
        return at, np.flatnonzero(end) + 1, self.row_of(at)

    def row_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, at, side="right") - 1

    def characters(self) -> np.ndarray:
        """1 for the first byte of each code point."""
        return (self.data & 0xC0) != 0x80

    def hashes(self, data: np.ndarray | None = None) -> Rolling:
        return Rolling(_BYTE_VALUE[self.data if data is None else data])


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    bounds = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if n and texts.buffers()[2] is not None and texts.buffers()[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1)
        yield Block(first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
        first = last


def repeated(values: np.ndarray) -> np.ndarray:
    """True where a value occurs at least twice."""
    ordered = np.sort(values)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(values), bool)
    twice = twice[np.concatenate(([True], twice[1:] != twice[:-1]))]
    at = np.searchsorted(twice, values)
    at[at == len(twice)] = 0
    return twice[at] == values


def later(values: np.ndarray) -> np.ndarray:
    """True where an equal value stands further in front."""
    _, first = np.unique(values, return_index=True)
    out = np.ones(len(values), bool)
    out[first] = False
    return out


def sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sum of the values of each row."""
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64) if len(rows) else np.zeros(n, np.int64)
