"""Suffix array by linear grouping construction.

Suffixes start in groups by their first symbol.  Groups are taken from the greatest down; a
suffix's previous-smaller pointer is the nearest one before it in a smaller group.  The
suffixes pointed to are extended by the group's prefix: they leave their group for a new one
right above it, those pointed to more often above the others.  When all groups are done, each
holds the suffixes that share their longest Lyndon prefix, in the order of these prefixes.

The second pass emits the order within groups: going through the sorted suffixes in ascending
order, the suffix before each one, and along its pointers those not placed yet, takes the next
free place of its group.  Nothing is renamed and nothing recurses.
"""

from __future__ import annotations

import numpy as np


def group_suffixes(symbols: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """(group start of each suffix, previous-smaller pointer of each, -1 for none, suffixes by
    group).  Groups are named by the first place of theirs in the suffix order."""
    n = len(symbols)
    by = np.argsort(symbols, kind="stable")
    ordered = symbols[by]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if n else np.zeros(0, np.int64)
    width = np.diff(np.r_[first, n])
    group_of, place = np.empty(n, np.int64), np.empty(n, np.int64)
    group_of[by] = np.repeat(first, width)
    place[by] = np.arange(n)
    held, place, group, size = by.tolist(), place.tolist(), group_of.tolist(), [0] * (n + 1)
    for a, w in zip(first.tolist(), width.tolist()):
        size[a] = w
    smaller = [-1] * n
    end = n
    while end:
        g = group[held[end - 1]]
        members = held[g:end]
        if end - g > 1:
            members.sort()
        end = g
        pointed: dict[int, int] = {}
        most = 1
        for s in members:
            j = s - 1
            while j >= 0 and group[j] >= g:
                j = smaller[j]
            smaller[s] = j
            if j >= 0:
                if j in pointed:
                    pointed[j] += 1
                    if pointed[j] > most:
                        most = pointed[j]
                else:
                    pointed[j] = 1
        if most == 1:
            rounds = [list(pointed)]
        else:
            levels: dict[int, list[int]] = {}
            for p, times in pointed.items():
                levels.setdefault(times, []).append(p)
            rounds = [levels[t] for t in sorted(levels, reverse=True)]
        for leaving in rounds:
            for p in leaving:  # to the end of its group
                h = group[p]
                size[h] -= 1
                e = h + size[h]
                q, other = place[p], held[e]
                held[q], held[e] = other, p
                place[other], place[p] = q, e
            new: dict[int, int] = {}
            for p in leaving:
                h = group[p]
                if h not in new:
                    new[h] = h + size[h]
                    size[new[h]] = 0
                group[p] = new[h]
                size[new[h]] += 1
    return group, smaller, held


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in ascending order; the last symbol must be the only smallest one."""
    n = len(symbols)
    if n < 2:
        return np.arange(n)
    group, smaller, _ = group_suffixes(symbols)
    out = [-1] * n
    free = list(range(n))
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            at = free[g]
            out[at] = j
            free[g] = at + 1
            placed[j] = 1
            j = smaller[j]
    return np.array(out, np.int64)
