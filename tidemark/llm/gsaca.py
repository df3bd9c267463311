"""Suffix arrays of many short strings at once, by linear grouping.

First the suffixes of a string are grouped by their first byte. Groups are taken in descending order; for the suffixes of a
group, the nearest suffix to the left that lies in a lower group (their previous-smaller pointer) is moved, with all others that
the same number of pointers reach, into a new group right behind its old one. In the end a group holds the
suffixes with one and the same longest Lyndon prefix. Then, from the smallest suffix on, the suffix to the left of
each one, and those along its pointers, take the next free place of their groups, which is their final one. Nothing is renamed.

Every step is done for all strings together with numpy: step t takes the t-th highest group of each string.
"""

from __future__ import annotations

import numpy as np


def suffix_arrays(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array of each string: ``data`` holds the strings one after the other, small non-negative numbers, ``sizes`` their lengths.

    Each string must end with a 0 that occurs nowhere else in it. The result has, string by string, the places in ``data``.
    """
    count = len(sizes)
    base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    total = int(base[-1])
    owner = np.repeat(np.arange(count), sizes)
    width = int(data.max()) + 1 if total else 1
    key = owner * width + data
    # Places of the strings have one before each string (its pointers end there): place = index + string + 1.
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    opens = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    starts = np.flatnonzero(opens)
    group_at = np.repeat(starts, np.diff(np.append(starts, total)))
    at = order + owner[order] + 1
    places = total + count + 1
    group = np.full(places, -1, np.int64)
    rank = np.zeros(places, np.int64)
    group[at], rank[at] = group_at, np.arange(total)
    size = np.zeros(total + 1, np.int64)
    size[starts] = np.diff(np.append(starts, total))
    start_of = np.zeros(total + 1, np.int64)
    start_of[starts + size[starts]] = starts
    left = np.arange(-1, places - 1)
    moving = np.zeros(places, bool)

    top, live = base[1:].copy(), np.flatnonzero(sizes > 0)
    while len(live):
        start = start_of[top[live]]
        spans = top[live] - start
        own = at[np.repeat(start, spans) + _steps(spans)]
        mine = np.repeat(start, spans)
        open_ = np.arange(len(own))
        while True:
            higher = group[left[own[open_]]] >= mine[open_]
            if not higher.any():
                break
            open_ = open_[higher]
            left[own[open_]] = left[left[own[open_]]]
        top[live] = start
        live = live[start > base[live]]
        reached = left[own]
        reached = reached[group[reached] >= 0]
        if not len(reached):
            continue
        reached, times = np.unique(reached, return_counts=True)
        old = group[reached]
        by = np.lexsort((times, old))
        reached, times, old = reached[by], times[by], old[by]
        new_old = np.concatenate([[True], old[1:] != old[:-1]])
        heads = np.flatnonzero(new_old)
        moved = np.diff(np.append(heads, len(old)))
        low = old[heads]
        tail = low + size[low] - moved
        spot = np.repeat(tail, moved) + _steps(moved)
        # Whatever stood in the tail of an old group goes where the moved ones came from.
        moving[reached] = True
        held = at[spot]
        pushed = held[~moving[held]]
        was = rank[reached]
        freed = np.sort(was[was < np.repeat(tail, moved)])
        at[freed], rank[pushed] = pushed, freed
        at[spot], rank[reached] = reached, spot
        moving[reached] = False
        size[low] -= moved
        remain = size[low] > 0
        start_of[tail[remain]] = low[remain]
        cut = np.flatnonzero(new_old | np.concatenate([[True], times[1:] != times[:-1]]))
        length = np.diff(np.append(cut, len(old)))
        group[reached] = np.repeat(spot[cut], length)
        size[spot[cut]] = length
        start_of[spot[cut] + length] = spot[cut]

    suffixes = np.zeros(total, np.int64)
    filled = np.zeros(total + 1, np.int64)
    done = np.zeros(places, bool)
    live = np.flatnonzero(sizes > 0)
    last = base[1:][live] + live
    suffixes[base[live]] = last
    filled[base[live]] = 1
    done[last] = True
    step = 0
    while len(live):
        at_ = suffixes[base[live] + step] - 1
        while True:
            at_ = at_[(group[at_] >= 0) & ~done[at_]]
            if not len(at_):
                break
            home = group[at_]
            suffixes[home + filled[home]] = at_
            filled[home] += 1
            done[at_] = True
            at_ = left[at_]
        step += 1
        live = live[sizes[live] > step]
    return suffixes - owner - 1


def _steps(spans: np.ndarray) -> np.ndarray:
    """0, 1, ... within each span."""
    ends = np.cumsum(spans)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - spans, spans)
