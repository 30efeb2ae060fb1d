"""Words, shingles and rolling hashes of whole Arrow columns of text, computed with numpy inside tasks.

A column is looked at as one run of UTF-8 bytes with the offsets of its rows, so no step loops over
words in Python.  Rows are taken in slices of a megabyte; a longer row is a slice of its own.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BYTE = np.random.default_rng(20250611).integers(1, 2**63, 256, dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) <= n:
        size = max(n + 1, 2 * len(_POWERS[0]))
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64 (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefixes:
    """Prefix polynomial hashes of a run of bytes: any substring's hash in constant time."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers(len(data) + 1)
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(_BYTE[data] * power[: len(data)], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def all(self, size: int) -> np.ndarray:
        """The hashes of every substring of ``size`` bytes."""
        return (self.sums[size:] - self.sums[:-size]) * self.inverse[: len(self.sums) - size]


class Words(NamedTuple):
    hash: np.ndarray  # of the word's bytes, A-Z in lower case
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(first row, bytes, offsets) of consecutive rows; null reads as empty."""
    column = pc.fill_null(column, "") if pa.types.is_string(column.type) else pc.fill_null(column, b"")
    column = column.cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1, first + 1)
        cut = offsets[first:last + 1]
        yield first, data[cut[0]:cut[-1]], cut - cut[0]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words `[^ \\t-\\r]+` of every row, in order."""
    data = LOWER[data]
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # a row's first byte, and the end
    before = np.concatenate([[False], solid[:-1]]) if len(data) else solid
    after = np.concatenate([solid[1:], [False]]) if len(data) else solid
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    hashes = mix(Prefixes(data).of(start, end) + (end - start).astype(np.uint64))
    return Words(hashes, np.searchsorted(offsets, start, "right") - 1, start, end)


def shingles(found: Words, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``size`` words; a row of fewer words is one run of them all."""
    count = np.bincount(found.row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    out_rows, out = [], []
    with np.errstate(over="ignore"):
        run = found.hash
        for k in range(1, size + 1):
            if k > 1:
                run = mix(run[:-1] * np.uint64(_BASE) + found.hash[k - 1:])
            if k < size:
                at = np.flatnonzero(count == k)
                out_rows.append(at)
                out.append(mix(run[first[at]] + np.uint64(k)) if len(at) else np.zeros(0, np.uint64))
            elif len(run) > 0:
                whole = found.row[: len(run)] == found.row[size - 1:]
                out_rows.append(found.row[: len(run)][whole])
                out.append(run[whole])
    return np.concatenate(out_rows), np.concatenate(out)


def polynomial(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` words, of whatever rows, in constant time each."""
    power, inverse = _powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[: len(hashes)], dtype=np.uint64, out=sums[1:])
    return (sums[size:] - sums[:-size]) * inverse[: len(sums) - size]


def distinct(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (row, hash) once, by row and hash."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def minima(hashes: np.ndarray, starts: np.ndarray, count: int, seed: int) -> np.ndarray:
    """(rows, count) minima under ``count`` seeded hash functions; ``starts`` begin the non-empty rows."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 2**63, count, dtype=np.uint64)
    out = np.empty((len(starts), count), np.uint64)
    for k in range(count):
        out[:, k] = np.minimum.reduceat(hashes * factors[k] + shifts[k], starts)
    return out


def band_keys(lows: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(rows, bands) signed keys, each of ``rows`` neighbouring minima and the band's number."""
    lows = lows[:, : bands * rows].reshape(len(lows), bands, rows)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), lows.shape[:2])
    for k in range(rows):
        key = mix(key * np.uint64(_BASE) + lows[:, :, k])
    return key.view(np.int64) if key.flags["C_CONTIGUOUS"] else np.ascontiguousarray(key).view(np.int64)


def lists(values: np.ndarray, per_row: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Flat ``values`` as lists of ``per_row`` lengths."""
    offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
