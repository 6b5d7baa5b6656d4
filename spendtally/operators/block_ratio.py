"""Ratio of matching blocks for many pairs of texts at once.

The longest common block of a pair is found first, the earliest in the first
text and then in the second among equals; what lies to its left and to its
right is searched in the same way.  All open pieces of all pairs are searched
together, one level after the other, with array arithmetic over the batch.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

# --- fixed values -----------------------------------------------------------
# In a second text of this length, characters that make up more than 1 % of it, and one more, start no block.
POPULAR_LENGTH = 200
# ----------------------------------------------------------------------------

#: Cells of the widest table held at once.
CELLS = 1 << 21
_OUTSIDE = 0xFFFFFFFF


def _code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, and where each starts (one entry more than texts)."""
    ends = np.cumsum([0] + [len(t) for t in texts])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), ends


def _popular(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes), bool)
    for i in np.flatnonzero(np.diff(ends) >= POPULAR_LENGTH):
        own = codes[ends[i] : ends[i + 1]]
        _, which, n = np.unique(own, return_inverse=True, return_counts=True)
        out[ends[i] : ends[i + 1]] = n[which] > len(own) // 100 + 1
    return out


def _longest(a, b, usable, a0, a1, b0, b1):
    """Longest block of every piece: (start in a, start in b, size); pieces come with the widest in a first."""
    width = int((b1 - b0).max())
    place = np.arange(width)
    at = b0[:, None] + place
    inside = at < b1[:, None]
    at = np.minimum(at, len(b) - 1)
    window = np.where(inside & usable[at], b[at], _OUTSIDE)
    size, i, j = np.zeros(len(a0), np.int64), a0.copy(), b0.copy()
    runs = np.zeros((len(a0), width + 1), np.int32)
    lengths = a1 - a0
    for x in range(int(lengths[0])):
        n = int(np.searchsorted(-lengths, -x))  # pieces longer than x
        same = window[:n] == a[a0[:n] + x][:, None]
        runs[:n, 1:] = np.where(same, runs[:n, :-1] + 1, 0)
        best = runs[:n, 1:].max(axis=1)
        better = np.flatnonzero(best > size[:n])
        if len(better):
            k = best[better].astype(np.int64)
            size[better] = k
            i[better] = a0[better] + x - k + 1
            j[better] = b0[better] + runs[better, 1:].argmax(axis=1) - k + 1
    return i, j, size


def _stretched(a, b, i, j, size, a0, a1, b0, b1):
    """Blocks grown to both sides over characters that start none."""
    while len(more := np.flatnonzero((i > a0) & (j > b0))):
        more = more[a[i[more] - 1] == b[j[more] - 1]]
        if not len(more):
            break
        i[more] -= 1
        j[more] -= 1
        size[more] += 1
    while len(more := np.flatnonzero((i + size < a1) & (j + size < b1))):
        more = more[a[i[more] + size[more]] == b[j[more] + size[more]]]
        if not len(more):
            break
        size[more] += 1
    return i, j, size


def block_ratios(first: Sequence[str], second: Sequence[str]) -> np.ndarray:
    """2 * M / (length of both) for each pair, M the length of all matching blocks; 1 for two empty texts."""
    a, a_ends = _code_points(first)
    b, b_ends = _code_points(second)
    usable = ~_popular(b, b_ends)
    matched = np.zeros(len(first), np.int64)
    pieces = (np.arange(len(first)), a_ends[:-1], a_ends[1:], b_ends[:-1], b_ends[1:])
    while True:
        keep = (pieces[1] < pieces[2]) & (pieces[3] < pieces[4])
        pieces = tuple(p[keep] for p in pieces)
        if not len(pieces[0]):
            break
        # pieces of about the same width share a table
        pieces = tuple(p[np.argsort(pieces[3] - pieces[4], kind="stable")] for p in pieces)
        found, start = [], 0
        while start < len(pieces[0]):
            width = int(pieces[4][start] - pieces[3][start])
            some = tuple(p[start : start + max(1, CELLS // (width + 1))] for p in pieces)
            start += len(some[0])
            some = tuple(p[np.argsort(some[1] - some[2], kind="stable")] for p in some)
            pair, a0, a1, b0, b1 = some
            i, j, k = _stretched(a, b, *_longest(a, b, usable, a0, a1, b0, b1), a0, a1, b0, b1)
            np.add.at(matched, pair, k)
            hit = k > 0
            pair, a0, a1, b0, b1, i, j, k = (v[hit] for v in (pair, a0, a1, b0, b1, i, j, k))
            found += [(pair, a0, i, b0, j), (pair, i + k, a1, j + k, b1)]
        pieces = tuple(np.concatenate(p) for p in zip(*found))
    both = np.diff(a_ends) + np.diff(b_ends)
    return np.where(both == 0, 1.0, 2.0 * matched / np.maximum(both, 1))
