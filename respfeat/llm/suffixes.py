"""Suffix arrays by linear grouping (Baier 2016), in numpy for many short strings at once.

Phase 1 groups suffixes by their Lyndon prefixes. Groups are taken in descending order; each
member finds the nearest position before it that lies in a lower group (its previous
smaller suffix), and positions found equally often move together to new groups right
above their own. Phase 2 goes through the suffixes in ascending order and places the
position before each, and its previous-smaller chain, at the front of their groups. No
string is renamed or sorted again.

Every string must end in a symbol that is smaller than all others and occurs once.
"""

from __future__ import annotations

import numpy as np


def suffix_array(s: np.ndarray) -> list[int]:
    """One string of any length."""
    n = len(s)
    sa = np.argsort(s, kind="stable").tolist()
    sym = s.tolist()
    link, isa, size, prev = [0] * n, [0] * n, [0] * n, [-1] * n
    start = 0
    for k, i in enumerate(sa):
        if k and sym[i] != sym[sa[k - 1]]:
            start = k
        link[i], isa[i] = start, k
        size[start] += 1
    end = n
    while end > 0:
        group = link[sa[end - 1]]
        times: dict[int, int] = {}
        for i in sorted(sa[group:end]):
            p = i - 1
            while p >= 0 and link[p] >= group:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        # Most often found first: each lot goes right above what remains of its group.
        lots: dict[tuple[int, int], list[int]] = {}
        for p, t in times.items():
            lots.setdefault((-t, link[p]), []).append(p)
        for (_, own), lot in sorted(lots.items()):
            top = own + size[own]
            for p in lot:
                top -= 1
                other, at = sa[top], isa[p]
                sa[top], sa[at] = p, other
                isa[p], isa[other] = top, at
            size[own] -= len(lot)
            size[top] = len(lot)
            for p in lot:
                link[p] = top
        end = group
    out, placed, free = [0] * n, [False] * n, list(range(n))
    out[0] = n - 1
    placed[n - 1] = True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = link[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = prev[j]
    return out


def suffix_arrays(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Strings one after another -> their suffix arrays, as positions in ``flat``."""
    n, count = len(flat), len(lengths)
    base = (np.cumsum(lengths) - lengths).astype(np.int32)
    of = np.repeat(np.arange(count, dtype=np.int32), lengths)
    sa = np.lexsort((flat, of)).astype(np.int32)
    isa = np.empty(n, np.int32)
    isa[sa] = np.arange(n, dtype=np.int32)
    heads = np.ones(n, bool)
    heads[1:] = (flat[sa[1:]] != flat[sa[:-1]]) | (of[sa[1:]] != of[sa[:-1]])
    starts = np.flatnonzero(heads).astype(np.int32)
    link, size = np.empty(n, np.int32), np.zeros(n, np.int32)
    link[sa] = np.repeat(starts, np.diff(np.append(starts, n)))
    size[starts] = np.diff(np.append(starts, n))
    prev, moving = np.full(n, -1, np.int32), np.zeros(n, bool)
    first = np.zeros(n, bool)
    first[base] = True

    live, end = np.arange(count), (base + lengths).astype(np.int32)
    while len(live):
        group = link[sa[end[live] - 1]]
        width = end[live] - group
        at = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width) + np.repeat(group, width)
        m, low = sa[at], np.repeat(group, width)
        prev[m] = np.where(first[m], -1, m - 1)
        left, edge = m, low
        while len(left):
            p = prev[left]
            on = (p >= 0) & (link[p] >= edge)
            left, edge = left[on], edge[on]
            prev[left] = prev[p[on]]
        p = prev[m]
        p = np.sort(p[p >= 0])
        if len(p):
            new = np.flatnonzero(np.diff(p, prepend=-1))
            times = np.diff(np.append(new, len(p)))
            p = p[new]
            own = link[p]
            order = np.lexsort((times, own))
            p, own, times = p[order], own[order], times[order]
            lot = np.flatnonzero(np.diff(own, prepend=-1))
            many = np.diff(np.append(lot, len(p)))
            rank = np.arange(len(p)) - np.repeat(lot, many)
            slots = own + size[own] - np.repeat(many, many) + rank
            moving[p] = True
            there = sa[slots]
            pushed = there[~moving[there]]
            emptied = isa[p][isa[p] < slots - rank]
            sa[emptied], isa[pushed] = pushed, emptied
            sa[slots], isa[p] = p, slots
            moving[p] = False
            runs = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(times, prepend=-1) != 0))
            size[own[lot]] -= many
            wide = np.diff(np.append(runs, len(p)))
            size[slots[runs]] = wide
            link[p] = np.repeat(slots[runs], wide)
        end[live] = group
        live = live[group > base[live]]

    out, placed, free = np.empty(n, np.int32), np.zeros(n, bool), np.arange(n, dtype=np.int32)
    last = base + lengths.astype(np.int32) - 1
    out[base], placed[last] = last, True
    by_length = np.argsort(-lengths, kind="stable")
    ordered = base[by_length]
    for i in range(int(lengths.max()) if count else 0):
        now = ordered[: int(np.searchsorted(-lengths[by_length], -i, side="left"))]
        j = out[now + i]
        j = j[~first[j]] - 1
        j = j[~placed[j]]
        while len(j):
            slot = free[link[j]]
            out[slot] = j
            free[link[j]] += 1
            placed[j] = True
            j = prev[j]
            j = j[j >= 0]
            j = j[~placed[j]]
    return out
