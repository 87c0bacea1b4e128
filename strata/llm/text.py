"""Words and shingles of whole Arrow text columns, as numpy arrays.

A word is a run of bytes other than ``0x20`` and ``0x09-0x0D``; words are compared after lower-casing A-Z. Words and
shingles are represented by 64-bit hashes: a polynomial over the bytes, taken from one prefix sum over the buffer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
SLICE_BYTES = 1 << 20
SLICE_ROWS = 2000

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the public splitmix64 finisher)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D
STEP = mix(np.arange(301, 301 + 64, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2^64."""
    if len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, and where each row begins and ends in them; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset :][: len(column) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = offsets.astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of bounded size with their bytes and offsets; a row longer than a slice makes one of its own."""
    data, offsets = buffers(column)
    row, rows = 0, len(column)
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        end = min(max(end, row + 1), row + SLICE_ROWS, rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end, and for each row (and one past it) the number of its first word."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | cut[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def range_hashes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of the bytes between each bound and the next, case kept."""
    return _ranges(data, bounds[:-1], bounds[1:])


def range_word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word, case kept."""
    return _ranges(data, starts, ends)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and for each row (and one past it) the number of its first word."""
    starts, ends, first = word_bounds(data, offsets)
    return _ranges(LOWER[data], starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``size`` words (of the whole row where it has fewer), with each row's first one."""
    n = np.diff(first)
    total = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size if len(total) else 0):
        total += words[k : len(words) - size + 1 + k] * STEP[k]
    total = mix(total + np.uint64(size))
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    bounds = np.concatenate(([0], np.cumsum(count)))
    out = np.empty(bounds[-1], np.uint64)
    for row in range(len(n)):
        a, b = bounds[row], bounds[row + 1]
        if n[row] >= size:
            out[a:b] = total[first[row] : first[row] + b - a]
        elif n[row]:
            few = words[first[row] : first[row + 1]]
            out[a] = mix((few * STEP[: len(few)]).sum(dtype=np.uint64)[None] + np.uint64(len(few)))[0]
    return out, bounds


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate((values[:1] == values[:1], values[1:] != values[:-1]))]
