"""Suffix sorting by hash comparison.

Two suffixes are compared in a logarithmic number of steps: their common extension is found
by binary search over prefix polynomial hashes, then one byte decides.  The sort is a bottom-up
mergesort, all pairs of runs of a round at once: an element's place in the merged run is
its place in its own run plus its rank in the other, found by binary search with that
comparison.  The order is verified byte by byte, neighbour by neighbour; should a hash have
collided, the bytes themselves are sorted.
"""

from __future__ import annotations

import numpy as np

from .hashing import spans


def common(s: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Bytes that the suffixes at a and b share, up to limit (both have that many)."""
    lo, hi = np.zeros(len(a), np.int64), np.full(len(a), limit, np.int64)
    for _ in range(int(limit).bit_length()):
        mid = (lo + hi + 1) >> 1
        same = spans(s, a, a + mid) == spans(s, b, b + mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, np.maximum(mid - 1, lo))
    return lo


def _less(raw, s, a, b, limit, or_equal):
    n = common(s, a, b, limit)
    at = np.minimum(n, limit - 1)
    return np.where(n == limit, or_equal, raw[a + at] < raw[b + at])


def sort_suffixes(raw: np.ndarray, s: np.ndarray, starts: np.ndarray, segment: np.ndarray, limit: int):
    """(order, shared): starts in suffix order inside each segment, by their first limit bytes, and
    the bytes each shares with its predecessor (-1 at a segment's first).  segment is ascending.
    """
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
    sizes = np.diff(np.r_[first, n])
    begin, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
    order, width = np.arange(n), 1
    while width < int(sizes.max()):
        at = np.flatnonzero(size > width)  # places whose segment still has runs to merge
        place = at - begin[at]
        block = place // (2 * width) * (2 * width)
        right = (place - block) >= width
        end = size[at]
        other_lo = begin[at] + np.minimum(np.where(right, block, block + width), end)
        other_hi = begin[at] + np.minimum(np.where(right, block + width, block + 2 * width), end)
        own = starts[order[at]]
        lo, hi = other_lo.copy(), other_hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            # Equal elements of the left run come first.
            below = _less(raw, s, starts[order[mid]], own[open_], limit, right[open_])
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)
        to = begin[at] + block + (place - block - np.where(right, width, 0)) + (lo - other_lo)
        merged = order.copy()
        merged[to] = order[at]
        order, width = merged, 2 * width
    a, b = starts[order[:-1]], starts[order[1:]]
    shared = np.r_[-1, common(s, a, b, limit)]
    shared[first] = -1
    if not _sorted(raw, a, b, shared[1:], limit):
        rows = raw[starts[:, None] + np.arange(limit)]
        order = np.lexsort((*rows.T[::-1], segment))
        rows = rows[order]
        differs = rows[1:] != rows[:-1]
        shared = np.r_[-1, np.where(differs.any(1), differs.argmax(1), limit)]
        shared[first] = -1
    return order, shared


def _sorted(raw, a, b, shared, limit) -> bool:
    """Whether the neighbours of each segment share the bytes they are said to share, and no more, and ascend.

    If all do, the order is right and equal strings stand together, whatever hashes collided on the way.
    """
    pairs, step = np.flatnonzero(shared >= 0), np.arange(limit)
    for i in range(0, len(pairs), 1 << 14):
        some = pairs[i : i + (1 << 14)]
        x, y = raw[a[some][:, None] + step], raw[b[some][:, None] + step]
        differs = x != y
        at = differs.argmax(1)
        row = np.arange(len(some))
        n = np.where(differs[row, at], at, limit)
        if (n != shared[some]).any() or ((x[row, at] > y[row, at]) & (n < limit)).any():
            return False
    return True
