"""Suffix arrays in linear time by groups of Lyndon prefixes.

Suffixes are first grouped by their leading symbol. Groups are then visited in descending
order; each member points at the nearest suffix to its left that is in a lower group, and
suffixes pointed at move up into a group of their own behind the one they were in, the
higher the more members point at them. When all groups have been visited, a group holds the
suffixes with one Lyndon prefix, and groups are in the order of those prefixes. A second
pass takes suffixes in their final order and puts, along the same pointers, each one that
leads up to them into the next free place of its group. Nothing is renamed and sorted again.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of the suffixes of a text of non-negative integers, in ascending order.

    A suffix that is a prefix of another comes before it.
    """
    n = len(symbols) + 1  # the last suffix is empty and lowest
    if n == 1:
        return []
    text = np.array(symbols, dtype=np.int64)
    order = np.argsort(text, kind="stable")
    steps = np.diff(text[order], prepend=-1) != 0
    starts = np.flatnonzero(steps).tolist()
    group = np.zeros(n, np.int64)
    group[order] = np.cumsum(steps)
    group = group.tolist()
    listed = order.tolist()
    # Groups, lowest first: the empty suffix, then one for each symbol. A suffix that moves
    # up stays listed where it was; `size` counts those that are still there.
    members = [[n - 1]]
    members += [listed[a:b] for a, b in zip(starts, [*starts[1:], n - 1], strict=True)]
    size = [len(own) for own in members]
    count = len(members)
    above = [*range(1, count), -1]
    below = list(range(-1, count - 1))
    visited = [False] * count
    pointer = [-1] * n

    def raised(p: int, old: int) -> int:
        """A new group right behind `old`, with p in it."""
        new = len(members)
        members.append([p])
        size.append(1)
        size[old] -= 1
        visited.append(False)
        upper = above[old]
        above.append(upper)
        below.append(old)
        above[old] = new
        if upper >= 0:
            below[upper] = new
        group[p] = new
        return new

    current = count - 1
    while current > 0:
        visited[current] = True
        own = members[current]
        if size[current] != len(own):
            own = members[current] = [i for i in own if group[i] == current]
        # Pointers rise along the members, so those who point at one suffix are neighbours.
        times: dict[int, int] = {}
        for i in own:
            p = i - 1
            while p >= 0 and visited[group[p]]:
                p = pointer[p]
            pointer[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        if len(times) == 1:
            (p,) = times
            if size[group[p]] > 1:  # alone in its group, it can stay there
                raised(p, group[p])
        elif times:
            for level in sorted(set(times.values()), reverse=True):
                moved: dict[int, int] = {}
                for p, k in times.items():
                    if k != level:
                        continue
                    old = group[p]
                    new = moved.get(old)
                    if new is None:
                        moved[old] = raised(p, old)
                    else:
                        group[p] = new
                        members[new].append(p)
                        size[new] += 1
                        size[old] -= 1
        current = below[current]

    free = [0] * len(members)
    at, current = 0, 0
    while current >= 0:
        free[current] = at
        at += size[current]
        current = above[current]
    result = [-1] * n
    placed = [False] * n
    result[0] = n - 1
    placed[n - 1] = True
    for at in range(n):
        i = result[at] - 1
        while i >= 0 and not placed[i]:
            g = group[i]
            result[free[g]] = i
            free[g] += 1
            placed[i] = True
            i = pointer[i]
    return result[1:]
