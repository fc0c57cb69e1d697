"""Vectorised views of text batches: code points, lines, words and their hashes, as numpy arrays."""

from __future__ import annotations

from functools import cache

import numpy as np

LETTER, UPPER, DIGIT, SPACE, OTHER = 1, 2, 4, 8, 16
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)


@cache
def classes() -> np.ndarray:
    """Flags of every code point."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = LETTER | (UPPER if c.isupper() else 0)
        elif c.isalnum():
            out[i] = DIGIT
        elif c.isspace():
            out[i] = SPACE
    return out


@cache
def lower_table() -> np.ndarray:
    """Lower-case form of each code point, where that is one code point."""
    out = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero(classes() & UPPER):
        low = chr(i).lower()
        if len(low) == 1:
            out[i] = ord(low)
    return out


@cache
def _powers(n: int = 256) -> np.ndarray:
    p = np.ones(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(1, n):
            p[i] = p[i - 1] * _P
    return p


def code_points(texts: list[str], between: str = "\n") -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by ``between`` (one character), and where each text begins (and the end)."""
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    joined = between.join(texts) + between
    data = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return data, np.concatenate([[0], np.cumsum(lengths)])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x *= _Q
    x ^= x >> np.uint64(29)
    x *= _P
    x ^= x >> np.uint64(32)
    return x


def words(cp: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of letters and digits, and a 64-bit hash of its code points."""
    inside = (flags & (LETTER | DIGIT)) > 0
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    at = np.flatnonzero(inside)
    size = end - start
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.arange(len(at)) - np.repeat(first, size)
    table = _powers()
    # a word's later parts, past the table, are weighted by another odd factor for each turn
    value = (cp[at].astype(np.uint64) + np.uint64(1)) * table[place & 255]
    if (size > 256).any():
        value *= (np.uint64(2) * (place >> 8).astype(np.uint64) + np.uint64(1))
    return start, end, mix(np.add.reduceat(value, first))


def counts(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How often ``mask`` holds between consecutive bounds."""
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]
