"""Vectorised 64-bit hashes of words, of runs of units, and content-defined anchors.

All arithmetic is modulo 2**64. ``anchors`` is winnowing: of the grams that lie
within a window the smallest is its anchor, of equal ones the rightmost. Windows of
equal content have anchors of equal content at equal distance, wherever they stand,
so grouping by anchor brings all copies of a window together.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_M = U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _M, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words (runs of bytes other than white space) start and end, and the first
    word of each row (and the count of all words at the end)."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    p = powers(int(length.max()))
    inside = np.repeat(starts - np.concatenate(([0], np.cumsum(length)[:-1])), length)
    inside += np.arange(len(inside))
    first = np.cumsum(length) - length
    x = (data[inside].astype(np.uint64) + U(1)) * p[np.arange(len(inside)) - np.repeat(first, length)]
    return mix(np.add.reduceat(x, first) ^ (length.astype(np.uint64) << U(40)))


def grams(v: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` units, by doubling; ``len(v) - n + 1`` of them."""
    if len(v) < n:
        return np.zeros(0, np.uint64)
    out, done, h, size, m = None, 0, v, 1, _M
    while True:
        if n & size:
            k = len(v) - done - size + 1
            out = h[:k] if out is None else out[:k] * m + h[done:done + k]
            done += size
        if done == n:
            return mix(out)
        h = h[:len(h) - size] * m + h[size:]
        m = U((int(m) * int(m)) & 0xFFFFFFFFFFFFFFFF)
        size *= 2


def anchors(g: np.ndarray, w: int) -> np.ndarray:
    """For each ``w`` neighbouring grams the place of the smallest, the rightmost of equals."""
    if len(g) < w:
        return np.zeros(0, np.int32)
    v, at, size = g, np.arange(len(g), dtype=np.int32), 1

    def join(step):
        left, right = v[:len(v) - step], v[step:]
        take = right <= left
        return np.where(take, right, left), np.where(take, at[step:], at[:len(at) - step])

    while size * 2 <= w:
        v, at = join(size)
        size *= 2
    if size < w:
        v, at = join(w - size)
    return at
