"""Hashes of words and of runs of words as numpy arrays, for the operators that work on whole texts."""

from __future__ import annotations

import numpy as np
import xxhash

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(word) for word in words], dtype=np.uint64)


def _powers(count: int, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of a lane's base modulo 2^64, and those of its inverse."""
    known = _tables.get(lane)
    if known is None or len(known[0]) < count:
        size = max(4096, 2 * count)
        base = _BASES[lane]
        ones = np.ones(size, dtype=np.uint64)
        up, down = ones.copy(), ones.copy()
        up[1:], down[1:] = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        known = _tables[lane] = np.cumprod(up), np.cumprod(down)
    return known[0][:count], known[1][:count]


def run_hashes(hashes: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """A hash of every run of ``length`` words, from the words' hashes; the two lanes are independent."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    up, down = _powers(len(hashes), lane)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(mixed(hashes + np.uint64(lane)) * up, out=sums[1:])
    return mixed((sums[length:] - sums[:-length]) * down[:count])


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of every ``width`` values in a row, ``pick`` being ``np.minimum`` or ``np.maximum``."""
    span = 1
    while 2 * span <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[:-rest], values[rest:]) if rest else values
