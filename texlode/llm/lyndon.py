"""Suffix arrays by linear grouping, for many strings in step.

Phase 1 sorts suffixes into groups by their Lyndon prefix.  Groups are taken in
descending order.  Each member finds its previous smaller suffix by following
pointers that earlier groups have left; the suffixes found have their prefix
extended by the group's, once for each member that points at them, and move to
new groups above the rest of their old one, more repeats higher.

Phase 2 goes through the suffix array from its start.  Behind each suffix stand
those whose Lyndon prefix ends where it begins: the suffix before it, and along
the previous-smaller pointers on.  Each takes the next place of its group.
Nothing is renamed or sorted again.

Strings take every step together, so that one numpy call serves them all.
"""

from __future__ import annotations

import numpy as np


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after another."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def lyndon_groups(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group start of each suffix and its previous smaller suffix.

    String ``b`` is ``symbols[bounds[b]:bounds[b + 1]]``; groups are places in
    the suffix array of the string, and a pointer before the string is none.
    """
    n = len(symbols)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((symbols, owner))
    where = np.empty(n, dtype=np.int64)
    where[order] = np.arange(n)
    new = np.ones(n, dtype=bool)
    new[1:] = (symbols[order[1:]] != symbols[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    starts = np.flatnonzero(new)
    size = np.zeros(n, dtype=np.int64)
    size[starts] = np.diff(np.append(starts, n))
    group = np.empty(n, dtype=np.int64)
    group[order] = np.repeat(starts, size[starts])
    previous = np.arange(-1, n - 1)
    moved = np.zeros(n, dtype=bool)
    base, top = bounds[:-1].copy(), bounds[1:].copy()
    open_ = base < top
    base, top = base[open_], top[open_]
    while len(top):
        start = group[order[top - 1]]
        sizes = top - start
        members = order[_ranges(start, sizes)]
        low = np.repeat(base, sizes)
        at = np.repeat(start, sizes)
        # Follow the pointers past suffixes that are not smaller.
        chase, chase_low, chase_at = members, low, at
        while len(chase):
            target = previous[chase]
            on = (target >= chase_low) & (group[target] >= chase_at)
            chase, chase_low, chase_at = chase[on], chase_low[on], chase_at[on]
            previous[chase] = previous[target[on]]
        smaller = previous[members]
        smaller = np.sort(smaller[smaller >= low])
        if len(smaller):
            first = np.flatnonzero(np.append(True, smaller[1:] != smaller[:-1]))
            times = np.diff(np.append(first, len(smaller)))
            suffix = smaller[first]
            old = group[suffix]
            by = np.lexsort((times, old))
            suffix, old, times = suffix[by], old[by], times[by]
            change = np.append(True, old[1:] != old[:-1])
            run = np.flatnonzero(change)
            taken = np.diff(np.append(run, len(old)))
            old_run = old[run]
            to = np.repeat(old_run + size[old_run] - taken, taken)
            place = _ranges(old_run + size[old_run] - taken, taken)
            # The others move down into the places that become free.
            source = where[suffix]
            moved[suffix] = True
            present = order[place]
            displaced = present[~moved[present]]
            free = source[source < to]
            order[free] = displaced
            where[displaced] = free
            order[place] = suffix
            where[suffix] = place
            moved[suffix] = False
            size[old_run] -= taken
            split = np.flatnonzero(change | np.append(True, times[1:] != times[:-1]))
            sizes_new = np.diff(np.append(split, len(suffix)))
            size[place[split]] = sizes_new
            group[suffix] = np.repeat(place[split], sizes_new)
        top = start
        going = top > base
        if not going.all():
            base, top = base[going], top[going]
    return group, previous


def suffix_arrays(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Suffix array of each string, at the string's own places.

    The last symbol of a string must be smaller than all its others.
    """
    group, previous = lyndon_groups(symbols, bounds)
    n = len(symbols)
    out = np.empty(n, dtype=np.int64)
    filled = np.zeros(n, dtype=np.int64)
    placed = np.zeros(n, dtype=bool)
    base, end = bounds[:-1], bounds[1:]
    open_ = base < end
    base, end = base[open_], end[open_]
    out[base] = end - 1
    filled[base] = 1
    placed[end - 1] = True
    at = base.copy()
    while len(at):
        suffix = out[at] - 1
        low = base
        while True:
            on = suffix >= low
            on &= ~placed[suffix]
            suffix, low = suffix[on], low[on]
            if not len(suffix):
                break
            g = group[suffix]
            out[g + filled[g]] = suffix
            filled[g] += 1
            placed[suffix] = True
            suffix = previous[suffix]
        at = at + 1
        going = at < end
        if not going.all():
            base, end, at = base[going], end[going], at[going]
    return out
