"""Suffix arrays by linear grouping: Lyndon prefixes in descending order, previous-smaller pointers, one pass to emit.

Phase 1 keeps suffixes in groups, in order, that share a prefix, first their first symbol. Groups are taken from the
greatest down; by then the group's common prefix is the longest Lyndon prefix of each of its suffixes. For each suffix
of the group a pointer leads to the nearest suffix before it in the text that lies in a smaller group; the suffixes so
pointed at are longer by as many copies of the group's prefix as point there, and move, by that number, into new groups
right above the ones they leave.

Phase 2 walks the suffixes in their final order. The text position before each one, and on along the pointers, goes to
the front of what is left of its group, until a suffix is met that already has its place.

Each suffix is moved once as a pointer's target a group and placed once; nothing is renamed and there is no recursion.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(text: Sequence[int] | np.ndarray) -> list[int]:
    """Start positions of all suffixes in order; a proper prefix is smaller."""
    symbols = np.asarray(text, np.int64)
    n = len(symbols) + 1  # a sentinel below all symbols ends the text
    s = np.empty(n, np.int64)
    s[:-1] = symbols - (symbols.min() if n > 1 else 0) + 1
    s[-1] = 0
    order = np.argsort(s, kind="stable")
    head = np.concatenate(([True], s[order][1:] != s[order][:-1]))
    first = np.flatnonzero(head)
    starts = np.repeat(first, np.diff(np.append(first, n)))
    place_of, group_of, count = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n + 1, np.int64)
    place_of[order] = np.arange(n)
    group_of[order] = starts
    count[first] = np.diff(np.append(first, n))
    at, place, group, size = order.tolist(), place_of.tolist(), group_of.tolist(), count.tolist()
    # group[i]: where suffix i's group starts in ``at``; size by that start. group[-1] is the sentinel's, the smallest.
    before = list(range(-1, n - 1))

    end = n - 1
    while end > 0:
        start = group[at[end]]
        told: dict[int, int] = {}
        if start == end:
            i = at[end]
            p = before[i]
            while group[p] >= start:
                p = before[p]
            before[i] = p
            if p >= 0:
                a = group[p]
                m = size[a] - 1
                if m:
                    e = a + m
                    q, k = at[e], place[p]
                    at[k], at[e], place[q], place[p] = q, p, k, e
                    size[a], size[e], group[p] = m, 1, e
        else:
            for i in sorted(at[start : end + 1]):
                p = before[i]
                while group[p] >= start:
                    p = before[p]
                before[i] = p
                if p >= 0:
                    told[p] = told.get(p, 0) + 1
            by_copies: dict[int, list[int]] = {}
            for p, c in told.items():
                by_copies.setdefault(c, []).append(p)
            for c in sorted(by_copies, reverse=True):
                moved = by_copies[c]
                for p in moved:
                    a = group[p]
                    e = a + size[a] - 1
                    size[a] = e - a
                    q, k = at[e], place[p]
                    at[k], at[e], place[q], place[p] = q, p, k, e
                above = [group[p] + size[group[p]] for p in moved]
                for p, a in zip(moved, above, strict=True):
                    group[p] = a
                    size[a] += 1
        end = start - 1

    out = [0] * n
    out[0] = n - 1
    done = bytearray(n)
    done[n - 1] = 1
    free = list(range(n))  # by group start: the next place in it
    for k in range(n):
        i = out[k] - 1
        while i >= 0 and not done[i]:
            g = group[i]
            out[free[g]] = i
            free[g] += 1
            done[i] = 1
            i = before[i]
    return out[1:]
