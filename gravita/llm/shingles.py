"""Distinct word shingles of whole texts as 64-bit fingerprints, and minima of them under many orders.

A-Z are lower-cased; words are runs of bytes other than space and 0x09-0x0D; a text with fewer words
than a shingle has its whole sequence as its one shingle; null and empty texts have none.
"""

from __future__ import annotations

import numpy as np

from .substrings import Fingerprints, mixed

WORDS = 5
#: Bytes of a text whose words are hashed at once.
BLOCK = 1 << 20
_BYTES = Fingerprints(21)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct fingerprints."""
    a = np.frombuffer((text or "").encode("utf-8", "replace").lower(), np.uint8)
    space = np.concatenate([[True], _SPACE[a], [True]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    word, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        at = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, at + BLOCK)))
        sums, own = _BYTES.sums(a[at : ends[j - 1]]), slice(i, j)
        size = ends[own] - starts[own]
        word[own] = mixed((sums[ends[own] - at] - sums[starts[own] - at]) * _BYTES.down[starts[own] - at] + size.astype(np.uint64))
        i = j
    n = min(words, len(word))
    out = np.full(len(word) - n + 1, n, np.uint64)
    for i in range(n):
        out = mixed(out * _STEP + word[i : len(word) - n + 1 + i])
    return np.unique(out)


class Orders:
    """Random orders of fingerprints; a set's minima under them agree as often as the sets overlap."""

    def __init__(self, count: int, seed: int = 31):
        rng = np.random.default_rng(seed)
        self.flip = rng.integers(0, 1 << 63, count, np.uint64)
        self.times = rng.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)

    def minima(self, s: np.ndarray) -> np.ndarray:
        s = s ^ (s >> np.uint64(31))
        return np.array([((s ^ f) * t).min() for f, t in zip(self.flip, self.times, strict=True)], np.uint64)


def set_digest(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests that are equal for equal sets."""
    with np.errstate(over="ignore"):
        a, b = mixed(s * _STEP).sum(), mixed(s ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum()
    return tuple(np.array([a, b], np.uint64).view(np.int64).tolist())
