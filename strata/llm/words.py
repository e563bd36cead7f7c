"""Words and rolling hashes of Arrow string columns, vectorised over the bytes.

A word is a run of bytes other than space and the control characters 9 to 13. Hashes are
polynomials modulo 2**64 over mixed values, finished with a mixer; sums over any run come
from one prefix sum, so a window of 50 words costs as much as one of five.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_ONE = np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, base & (2**64 - 1), dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse, self.n = base, pow(base, -1, 2**64), 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, CHUNK + CHUNK // 8)
            self.up, self.down = _powers(self.base, self.n), _powers(self.inverse, self.n)
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BASE), _Powers(0xD6E8FEB86659FD93)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every other."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_LETTER = mix(np.arange(256, dtype=np.uint64), 7)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows one after another, null as empty, and the n + 1 row offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def parts(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `size` bytes; a longer row is a run of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    gap, cut = _GAP[data], np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    starts, ends = ~gap, ~gap
    starts[1:] &= gap[:-1] | cut[1:-1]
    ends[:-1] &= gap[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    up, down = _BYTES.upto(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_LETTER[_LOWER[data] if lower else data] * up[:-1], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts])


def run_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, seed: int = 0) -> np.ndarray:
    """One hash for each run first..last (excluded) of word hashes; the length counts too."""
    up, down = _WORDS.upto(len(hashes) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum((mix(hashes, seed) if seed else hashes) * up[:-1], out=total[1:])
        sums = (total[last] - total[first]) * down[first]
        return mix(sums + (last - first).astype(np.uint64), seed + 1)


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """The n + 1 bounds of the rows' words, given each word's row in ascending order."""
    return np.searchsorted(rows, np.arange(n + 1))


def windows(bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and row of each run of `length` words within a row."""
    counts = np.maximum(np.diff(bounds) - length + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    skipped = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - skipped[rows] + bounds[:-1][rows], rows


def hashed(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word, and the rows' bounds; done in parts to bound memory."""
    found: list[tuple[np.ndarray, ...]] = []
    for a, b in parts(offsets):
        base = int(offsets[a])
        piece = data[base : int(offsets[b])]
        starts, ends, rows = spans(piece, offsets[a : b + 1] - base)
        found.append((starts + base, ends + base, word_hashes(piece, starts, ends, lower), rows + a))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts, ends, hashes, rows = (np.concatenate(x) for x in zip(*found))
    return starts, ends, hashes, row_bounds(rows, len(offsets) - 1)
