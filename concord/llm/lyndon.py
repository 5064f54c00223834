"""Suffix arrays by grouping on Lyndon prefixes, for many short texts at once.

First phase: suffixes start grouped by their first byte. Groups are taken in descending order;
each member points to the previous position of a lower group, and the positions pointed to move
up within their own groups, those with more pointers higher. In the end a group holds the
suffixes with the same Lyndon prefix, in sorted order of groups. Second phase: going up the
suffix array, each suffix emits those whose Lyndon prefix ends where it begins to the next free
place of their groups. No step renames or recurses.

Lanes, independent texts laid end to end, take every step together, so that a step is a few
array operations for all of them. A long lane has more steps than others could share; it is
sorted alone, by the same two phases one suffix at a time.
"""

from __future__ import annotations

import numpy as np


def _ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[k], first[k] + 1, …`` (``size[k]`` numbers) for every ``k``, in one array."""
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)


#: Codes in a lane from which it is sorted alone.
ALONE = 1_500


def suffix_arrays(codes: np.ndarray, lanes: np.ndarray, alone: int = ALONE) -> np.ndarray:
    """Positions in suffix order within each lane; ``lanes`` are the edges, one more than lanes.

    The last code of a lane must be smaller than all its other codes.
    """
    size = np.diff(lanes)
    short = size < alone
    out = np.empty(len(codes), np.int64)
    for a, b in zip(lanes[:-1][~short].tolist(), lanes[1:][~short].tolist(), strict=True):
        out[a:b] = np.array(suffix_array(codes[a:b].tolist())) + a
    if short.any():
        mine = _ragged(lanes[:-1][short], size[short])
        out[mine] = mine[_together(codes[mine], np.append(0, np.cumsum(size[short])))]
    return out


def suffix_array(codes: list[int]) -> list[int]:
    """The suffix array of one text whose last code is its smallest and only one."""
    n = len(codes)
    sa = sorted(range(n), key=codes.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    head = 0
    for at, i in enumerate(sa):
        if codes[i] != codes[sa[head]]:
            head = at
        place[i], group[i] = at, head
        size[head] += 1
    previous = [-1] * n
    top = n - 1
    while top >= 0:
        own = group[sa[top]]
        pointers: dict[int, int] = {}
        for i in sa[own : top + 1]:
            at = i - 1
            while at >= 0 and group[at] >= own:
                at = at - 1 if group[at] == own else previous[at]
            previous[i] = at
            if at >= 0:
                pointers[at] = pointers.get(at, 0) + 1
        top = own - 1
        levels: dict[int, list[int]] = {}
        for i, count in pointers.items():
            levels.setdefault(count, []).append(i)
        for count in sorted(levels, reverse=True):  # more pointers, higher group
            fresh: dict[int, int] = {}
            moved = levels[count]
            for i in moved:
                old = group[i]
                size[old] -= 1
                slot = old + size[old]  # to the end of its group, which gets shorter
                other = sa[slot]
                sa[slot], sa[place[i]] = i, other
                place[other], place[i] = place[i], slot
                fresh[old] = slot
            for i in moved:
                group[i] = fresh[group[i]]
                size[group[i]] += 1
    out = [-1] * n
    free = list(range(n))
    placed = [False] * n
    out[0], placed[n - 1] = n - 1, True
    for step in range(n):
        at = out[step] - 1
        while at >= 0 and not placed[at]:
            g = group[at]
            out[free[g]] = at
            free[g] += 1
            placed[at] = True
            at = previous[at]
    return out


def _together(codes: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    """The suffix arrays of short lanes, step by step for all."""
    n = len(codes)
    begins, ends = lanes[:-1], lanes[1:]
    lane = np.repeat(np.arange(len(begins)), np.diff(lanes))
    sa = np.lexsort((codes, lane))
    place = np.empty(n, np.int64)
    place[sa] = np.arange(n)
    head = np.ones(n, bool)
    head[1:] = (codes[sa[1:]] != codes[sa[:-1]]) | (lane[sa[1:]] != lane[sa[:-1]])
    heads = np.flatnonzero(head)
    size = np.zeros(n, np.int64)
    size[heads] = np.diff(np.append(heads, n))
    group = np.empty(n, np.int64)
    group[sa] = np.repeat(heads, size[heads])
    previous = np.full(n, -1, np.int64)
    pointed = np.zeros(n, bool)

    top = ends - 1  # of each lane, the last place whose group is still to come
    while True:
        busy = top >= begins
        if not busy.any():
            break
        start = group[sa[top[busy]]]
        members = sa[_ragged(start, top[busy] - start + 1)]
        top[busy] = start - 1
        own, floor = group[members], begins[lane[members]]
        at = members - 1
        open_ = np.arange(len(members))
        while len(open_):
            here = at[open_]
            inside = here >= floor[open_]
            at[open_[~inside]] = -1
            open_, here = open_[inside], here[inside]
            high = group[here] >= own[open_]
            open_, here = open_[high], here[high]
            at[open_] = np.where(group[here] == own[open_], here - 1, previous[here])
        previous[members] = at
        target, pointers = np.unique(at[at >= 0], return_counts=True)
        if not len(target):
            continue
        order = np.lexsort((pointers, group[target]))
        target, pointers = target[order], pointers[order]
        old = group[target]
        edge = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
        moved = np.diff(np.append(edge, len(old)))
        old_heads = old[edge]
        lowest = old_heads + size[old_heads] - moved
        slots = _ragged(lowest, moved)
        pointed[target] = True
        occupants = sa[slots]
        occupants = occupants[~pointed[occupants]]
        left = place[target]
        left = left[left < np.repeat(lowest, moved)]
        sa[left], place[occupants] = occupants, left
        sa[slots], place[target] = target, slots
        pointed[target] = False
        size[old_heads] -= moved
        fresh = np.flatnonzero(np.append(True, (old[1:] != old[:-1]) | (pointers[1:] != pointers[:-1])))
        count = np.diff(np.append(fresh, len(old)))
        size[slots[fresh]] = count
        group[target] = np.repeat(slots[fresh], count)

    out = np.full(n, -1, np.int64)
    placed = np.zeros(n, bool)
    free = np.arange(n)  # next free place of the group that begins here
    out[begins] = ends - 1
    placed[ends - 1] = True
    longest = np.argsort(begins - ends, kind="stable")
    first, length = begins[longest], (ends - begins)[longest]
    for step in range(int(length[0]) if len(length) else 0):
        alive = int(np.searchsorted(-length, -step, side="left"))
        low = first[:alive]
        at = out[low + step] - 1
        while True:
            go = at >= low
            go[go] = ~placed[at[go]]
            if not go.any():
                break
            at, low = at[go], low[go]
            groups = group[at]
            out[free[groups]] = at
            free[groups] += 1
            placed[at] = True
            at = previous[at]
    return out
