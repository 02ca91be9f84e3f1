"""Suffix sorting by linear grouping.

Suffixes are grouped by their Lyndon prefix, groups processed in descending
order: the suffixes of a group extend those that precede them in the text (by
the pointer to the previous suffix of a lower group), and how often a suffix is
extended parts its own group. When every group has been processed, the groups
are in order, and one pass emits each group's order by following the same
pointers from the suffixes already placed. No round of renaming is needed.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence of small non-negative integers."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # first grouping: by first symbol, groups side by side in `order`
    first = np.argsort(text, kind="stable")
    sym = text[first]
    cut = np.flatnonzero(np.concatenate([[True], sym[1:] != sym[:-1]]))
    width = np.diff(np.append(cut, n))
    order: list[int] = first.tolist()
    place = np.empty(n, np.int64)
    place[first] = np.arange(n)
    where: list[int] = place.tolist()
    link_of = np.empty(n, np.int64)
    link_of[first] = np.repeat(cut, width)
    link: list[int] = link_of.tolist()  # suffix -> start of its group
    size = [0] * (n + 1)
    for s, w in zip(cut.tolist(), width.tolist(), strict=True):
        size[s] = w
    prev = [-1] * n
    done = bytearray(n)

    end = n
    while end:
        start = link[order[end - 1]]
        group = sorted(order[start:end]) if end - start > 1 else order[start:end]
        hits: dict[int, int] = {}
        for i in group:  # left to right: earlier members already point past the group
            done[i] = 1
            j = i - 1
            while j >= 0 and done[j]:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                hits[j] = hits.get(j, 0) + 1
        end = start
        if not hits:
            continue
        # those extended most often become the highest part of their group
        by_times: dict[int, list[int]] = {}
        for j, k in hits.items():
            by_times.setdefault(k, []).append(j)
        for k in sorted(by_times, reverse=True):
            moved: dict[int, int] = {}
            members = by_times[k]
            for j in members:
                g = link[j]
                m = moved.get(g, 0) + 1
                moved[g] = m
                at, to = where[j], g + size[g] - m
                other = order[to]
                order[at], order[to] = other, j
                where[other], where[j] = at, to
            for g, m in moved.items():
                if m < size[g]:
                    new = g + size[g] - m
                    size[g] -= m
                    size[new] = m
                    for p in range(new, new + m):
                        link[order[p]] = new
    # emit: the empty suffix comes first; each placed suffix places its chain
    out = [-1] * n
    slot = list(range(n + 1))
    placed = bytearray(n)
    j = n - 1
    while j >= 0 and not placed[j]:
        g = link[j]
        out[slot[g]] = j
        slot[g] += 1
        placed[j] = 1
        j = prev[j]
    for r in range(n):
        j = out[r] - 1
        while j >= 0 and not placed[j]:
            g = link[j]
            out[slot[g]] = j
            slot[g] += 1
            placed[j] = 1
            j = prev[j]
    return np.array(out, np.int64)
