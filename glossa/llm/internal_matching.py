"""Internal pattern matching over word numbers: suffix array, wavelet tree, and the periodic runs they give.

A text is an array of word numbers.  ``runs`` finds every maximal stretch with smallest period q that is at least
``EXPONENT`` times as long:

1. The suffix array is built by doubling.  After round k suffixes are ordered by their first ``2**k`` words, so the suffixes that
   start with a given block of that length are one interval of it.
2. A dyadic block (length ``m = 2**k``, at a multiple of m) asks the wavelet tree over the suffix array for the range successor and
   predecessor of its own place inside its interval: its next and last occurrence in the neighbouring windows.
3. Occurrences of a block in a window of its own length are one arithmetic progression, whose difference is the candidate period.
   A stretch of period q and length >= 4 q holds a whole block with ``q < m <= 2 q`` and, q words before or behind, the
   block's next occurrence.  So a block of length m only has to report differences from m/2 up to m - 1, and each run is reported at one level.
4. Candidates are extended to both sides while words a period apart are equal.

Why the nearest occurrence is the period: were it at d < q, the words between would have the periods d and q over more than d + q words, hence the period
gcd(d, q), and q would not be the smallest.
"""

from __future__ import annotations

import numpy as np

EXPONENT = 4
SHORTEST = 6

#: Wavelet tree queries answered at once.
CHUNK = 1 << 17


class WaveletTree:
    """A wavelet tree over the numbers 0 .. n-1, level by level (highest bit first), with packed bits and counts per 64 of them."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.levels = max(1, int(n - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        v = values
        for level in range(self.levels - 1, -1, -1):
            bit = (v >> level) & 1
            packed = np.zeros(((n + 63) // 64 + 1) * 8, np.uint8)
            raw = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed[: len(raw)] = raw
            words = packed.view(np.uint64)
            self.bits.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)]))
            ones = bit.astype(bool)
            zero = v[~ones]
            self.zeros.append(len(zero))
            v = np.concatenate([zero, v[ones]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` entries of a level."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.bits[level][word] & low)

    def smaller(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the entries lo .. hi-1 are smaller than x."""
        out = np.zeros(len(x), np.int64)
        for level in range(self.levels):
            a, b = self._ones(level, lo), self._ones(level, hi)
            up = ((x >> (self.levels - 1 - level)) & 1).astype(bool)
            out += np.where(up, (hi - lo) - (b - a), 0)
            lo, hi = np.where(up, self.zeros[level] + a, lo - a), np.where(up, self.zeros[level] + b, hi - b)
        return out

    def nth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the entries lo .. hi-1."""
        out = np.zeros(len(k), np.int64)
        for level in range(self.levels):
            a, b = self._ones(level, lo), self._ones(level, hi)
            zeros = (hi - lo) - (b - a)
            up = k >= zeros
            k = np.where(up, k - zeros, k)
            out = (out << 1) | up
            lo, hi = np.where(up, self.zeros[level] + a, lo - a), np.where(up, self.zeros[level] + b, hi - b)
        return out

    def neighbours(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range predecessor and successor of x, itself among the entries lo .. hi-1; -1 where there is none."""
        k = self.smaller(lo, hi, x)
        before, after = np.full(len(x), -1, np.int64), np.full(len(x), -1, np.int64)
        has = np.flatnonzero(k > 0)
        before[has] = self.nth(lo[has], hi[has], k[has] - 1)
        has = np.flatnonzero(k + 1 < hi - lo)
        after[has] = self.nth(lo[has], hi[has], k[has] + 1)
        return before, after


def suffix_array(text: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array by doubling, and per level ``(m, places, lo, hi)``: the blocks of length m that occur more than once, with their intervals.

    Doubling stops when blocks are longer than half of ``longest``, the longest piece of text between two separators.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    key = text[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    heads = np.flatnonzero(new)
    first = heads[np.cumsum(new) - 1]
    rank = np.empty(n, np.int64)
    rank[order] = first
    at = np.flatnonzero(np.repeat(np.diff(np.append(heads, n)) > 1, np.diff(np.append(heads, n))))
    levels = []
    m = 1
    while len(at) and 4 * m <= longest:
        # order the suffixes of every undecided interval by the m words behind the first m; shorter ones come first
        x = order[at]
        far = x + m
        second = np.where(far < n, rank[np.minimum(far, n - 1)], -1)
        by = np.lexsort((second, rank[x]))
        x, second, own = x[by], second[by], rank[x[by]]
        order[at] = x
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (second[1:] != second[:-1])])
        heads = np.flatnonzero(new)
        size = np.diff(np.append(heads, len(at)))
        lo = np.repeat(at[heads], size)
        rank[x] = lo
        m *= 2
        more = np.repeat(size > 1, size)
        block = more & (x % m == 0)
        levels.append((m, x[block], lo[block], lo[block] + np.repeat(size, size)[block]))
        at = at[more]
    return order, levels


def _extent(text: np.ndarray, at: int, d: int) -> tuple[int, int]:
    """The maximal stretch of period d around the equal words at ``at`` and ``at + d``, as (start, stop)."""
    n, step, hi = len(text), 64, at
    while hi + d < n:
        top = min(n - d, hi + step)
        bad = np.flatnonzero(text[hi:top] != text[hi + d : top + d])
        if len(bad):
            hi += int(bad[0])
            break
        hi, step = top, step * 4
    lo, step = at, 64
    while lo > 0:
        low = max(0, lo - step)
        bad = np.flatnonzero(text[low:lo] != text[low + d : lo + d])
        if len(bad):
            lo = low + int(bad[-1]) + 1
            break
        lo, step = low, step * 4
    return lo, hi + d


def runs(text: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start and period.  Words that occur once (separators) end any run."""
    if len(text) < SHORTEST:
        return []
    order, levels = suffix_array(text, longest)
    if not levels or not any(len(places) for _, places, _, _ in levels):
        return []
    tree = WaveletTree(order)
    out = []
    for m, places, lo, hi in levels:
        found = []
        for c in range(0, len(places), CHUNK):
            x, a, b = places[c : c + CHUNK], lo[c : c + CHUNK], hi[c : c + CHUNK]
            before, after = tree.neighbours(a, b, x)
            for start, d in ((x, after - x), (before, x - before)):
                ok = (before >= 0 if start is before else after >= 0) & (2 * d >= m) & (d < m)
                found.append(np.stack([d[ok], start[ok]]))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
        period, stop = 0, 0
        for d, at in pairs.T.tolist():
            if d == period and at + d + m <= stop:
                continue
            start, stop = _extent(text, at, d)
            period = d
            if stop - start >= max(SHORTEST, EXPONENT * d):
                out.append((start, stop - start, d))
    return sorted(out, key=lambda r: (r[0], r[2]))
