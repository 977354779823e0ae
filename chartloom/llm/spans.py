"""Words of many texts at once, as positions and hashes in numpy arrays."""

from __future__ import annotations

from functools import cache

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
# Some thirty bytes are held for each character of these spans.
SPANS_AT_ONCE = 1 << 15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _letter_values() -> np.ndarray:
    """A random 64-bit value for each code point."""
    return mix(np.arange(1, 0x110001, dtype=np.uint64) * BASE)


_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE ** 0 .. BASE ** (n - 1), modulo 2 ** 64."""
    global _powers
    if len(_powers) < n:
        _powers = power_series(BASE, max(n, 4096))
    return _powers[:n]


def power_series(base: np.uint64, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def code_points(texts: list[str], between: str = "\n") -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points, and where each text starts in it.

    One separator stands after each text, the last one included.
    """
    joined = between.join([*texts, ""])
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    return codes, np.concatenate(([0], np.cumsum(lengths)))


def word_spans(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of characters other than \\x20 and \\x09-\\x0D."""
    inside = np.zeros(len(codes) + 2, dtype=np.int8)
    inside[1:-1] = (codes != 32) & ((codes < 9) | (codes > 13))
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def hash_spans(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans are sorted, not empty and do not overlap."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    if len(starts) > SPANS_AT_ONCE:
        cuts = range(0, len(starts), SPANS_AT_ONCE)
        return np.concatenate([hash_spans(codes, starts[i : i + SPANS_AT_ONCE], ends[i : i + SPANS_AT_ONCE]) for i in cuts])
    first, last = starts[0], ends[-1]
    lengths = ends - starts
    # +1 where a span starts, -1 where it ends; both at once where spans touch
    change = np.zeros(last - first + 1, dtype=np.int8)
    change[starts - first] += 1
    change[ends - first] -= 1
    own = codes[first:last][np.cumsum(change[:-1], dtype=np.int8).astype(bool)]
    begins = np.cumsum(lengths) - lengths
    place = np.arange(len(own)) - np.repeat(begins, lengths)
    values = _letter_values()[own] * powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, begins) + lengths.astype(np.uint64))
