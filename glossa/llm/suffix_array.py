"""Suffix array by linear grouping construction.

Phase 1 groups the suffixes by their longest Lyndon prefix.  It starts with one group per first symbol and goes through the
groups in descending order.  Each suffix of the current group finds the nearest suffix to its left in a lower group by
following previous-smaller pointers.  Those targets that are hit most often move to new groups right after their old
ones: their prefixes have been lengthened by the current group's.

Phase 2 emits the order of each group from the finished prefix of the array: the suffix left of an emitted one, and all its
previous-smaller ancestors, take the next free places of their groups.  Nothing is renamed and nothing recurses.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``symbols`` (non-negative integers); a suffix that is a prefix of another comes first."""
    n = len(symbols)
    if n < 2:
        return np.arange(n)
    ranks = np.append(np.unique(symbols, return_inverse=True)[1] + 1, 0)  # a smallest symbol ends the text
    n += 1
    order = np.argsort(ranks, kind="stable")
    sizes = np.bincount(ranks)
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    group = firsts[ranks].tolist()  # a group is named by its first place
    last = [0] * n  # by group
    for f, s in zip(firsts.tolist(), sizes.tolist()):
        last[f] = f + s - 1
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    where = where.tolist()
    at = order.tolist()
    smaller = [-1] * n

    stop = n - 1
    while stop >= 0:
        g = group[at[stop]]
        if g == stop:  # a group of one
            i = at[stop]
            j = i - 1
            while j >= 0 and group[j] > g:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                h = group[j]
                e = last[h]
                if e != h:
                    x, p = at[e], where[j]
                    at[p], where[x] = x, p
                    at[e], where[j] = j, e
                    last[h] = e - 1
                    group[j] = last[e] = e
            stop = g - 1
            continue
        members = sorted(at[g : stop + 1])
        hits: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                hits[j] = hits.get(j, 0) + 1
        by_hits: dict[int, list[int]] = {}
        for j, c in hits.items():
            by_hits.setdefault(c, []).append(j)
        for c in sorted(by_hits, reverse=True):
            ends: dict[int, int] = {}
            for j in by_hits[c]:
                h = group[j]
                e = last[h]
                if h not in ends:
                    ends[h] = e
                x, p = at[e], where[j]
                at[p], where[x] = x, p
                at[e], where[j] = j, e
                last[h] = e - 1
            for h, end in ends.items():
                new = last[h] + 1
                if new == h:
                    last[h] = end
                    continue
                last[new] = end
                for p in range(new, end + 1):
                    group[at[p]] = new
        stop = g - 1

    free = list(range(n))  # next free place by group
    out = [-1] * n
    placed = [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            placed[j] = True
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            j = smaller[j]
    return np.array(out[1:])
