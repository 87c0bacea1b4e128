"""HyperMinHash sketches of shingle sets.

The first byte of a shingle's 64-bit hash names one of 256 buckets; of the smallest remaining hash in a bucket only its
number of leading zeros and the ten bits after the first one are kept, as one 16-bit register. An empty bucket borrows
from the first filled one in an order of its own (the same for all sets), so that every register of two sets agrees
with about the probability of their Jaccard similarity, however small the sets are.
"""

from __future__ import annotations

import numpy as np

from strata.llm.text import mix

BUCKETS = 256
MANTISSA_BITS = 10
BAND_ROWS = 5
BANDS = BUCKETS // BAND_ROWS
_ZEROS = 54

_order = np.argsort(
    mix(np.arange(7, 7 + BUCKETS * BUCKETS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(BUCKETS, BUCKETS)
)
_RANK = np.empty((BUCKETS, BUCKETS), np.uint16)
np.put_along_axis(_RANK, _order, np.arange(BUCKETS, dtype=np.uint16)[None].repeat(BUCKETS, 0), 1)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers for each set (sorted distinct 64-bit hashes, not empty)."""
    rest = np.zeros((len(sets), BUCKETS), np.uint64)
    filled = np.zeros((len(sets), BUCKETS), bool)
    for row, values in enumerate(sets):
        bucket = (values >> np.uint64(56)).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        filled[row, bucket[first]] = True
        rest[row, bucket[first]] = values[first] << np.uint64(8)
    zeros = 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
    mantissa = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA_BITS)
    out = (zeros.astype(np.uint16) << np.uint16(MANTISSA_BITS)) | mantissa.astype(np.uint16)
    for row in np.flatnonzero(~filled.all(axis=1)):
        full, empty = np.flatnonzero(filled[row]), np.flatnonzero(~filled[row])
        out[row, empty] = out[row, full[_RANK[np.ix_(empty, full)].argmin(axis=1)]]
    return out


def bands(matrix: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row: its registers and its number."""
    keys = np.zeros((len(matrix), BANDS), np.uint64)
    for k in range(BAND_ROWS):
        keys = mix(keys ^ matrix[:, k : k + BANDS * BAND_ROWS : BAND_ROWS].astype(np.uint64)) + np.uint64(k + 1)
    return mix(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def accidental(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The probability that a register of two sets without a common shingle agrees, by their sizes."""
    edge = 2.0 ** -np.arange(_ZEROS + 1) / BUCKETS

    def zeros(size: np.ndarray) -> np.ndarray:
        none = np.exp(np.asarray(size, float)[..., None] * np.log1p(-edge))
        share = none[..., 1:] - none[..., :-1]
        return share / share.sum(axis=-1, keepdims=True)

    return (zeros(n) * zeros(m)).sum(axis=-1) / (1 << MANTISSA_BITS)


def estimate(agree: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of registers that agree, without those that agree by accident."""
    chance = accidental(n, m)
    return (agree - chance) / (1 - chance)


def spread(smaller: np.ndarray) -> np.ndarray:
    """A bound for the standard error of the estimate near a similarity of 0.75, by the size of the smaller set."""
    return np.sqrt(0.1875 * (1 / BUCKETS + 1 / smaller))
