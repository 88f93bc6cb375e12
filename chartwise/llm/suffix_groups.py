"""Suffix sorting by linear grouping.

Phase 1 takes groups of suffixes from the greatest down.  All members of a group share a prefix; for each member the
previous-smaller pointer names the nearest earlier suffix of a lesser group.  A suffix that members point to is
followed by that many copies of the group's prefix, so it moves to a group of its own right behind its old
one, suffixes with more copies behind those with fewer.  At the end each group holds the suffixes with the same longest
Lyndon prefix.  Phase 2 walks the order from its least suffix on and emits each group's members as their successors turn up,
following the same pointers.  No level is renamed and sorted again.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``text`` (integers) in ascending order.

    ``text`` must end with a symbol that is less than all others.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    ordered = text[order]
    start = np.searchsorted(ordered, ordered, side="left")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    group = np.empty(n, np.int64)
    group[order] = start
    sizes = np.bincount(start, minlength=n)
    order, place, group, sizes = order.tolist(), place.tolist(), group.tolist(), sizes.tolist()
    prev = [-1] * n

    end = n
    while end > 0:
        first = group[order[end - 1]]
        if end - first == 1:
            i = order[first]
            j = i - 1
            while j >= 0 and group[j] >= first:
                j = prev[j]
            prev[i] = j
            moved = ((j,),) if j >= 0 else ()
        else:
            copies: dict[int, int] = {}
            for i in sorted(order[first:end]):
                j = i - 1
                while j >= 0 and group[j] >= first:
                    j = prev[j]
                prev[i] = j
                if j >= 0:
                    copies[j] = copies.get(j, 0) + 1
            most = max(copies.values(), default=0)
            if most == 1:
                moved = (copies,)
            else:
                by: list[list[int]] = [[] for _ in range(most)]
                for j, c in copies.items():
                    by[most - c].append(j)
                moved = by
        for some in moved:
            for j in some:
                old = group[j]
                sizes[old] -= 1
                to, at = old + sizes[old], place[j]
                other = order[to]
                order[at], place[other] = other, at
                order[to], place[j] = j, to
            # what left an old group forms one new group behind it
            for j in some:
                new = group[j]
                new += sizes[new]
                group[j] = ~new
            for j in some:
                new = group[j] = ~group[j]
                sizes[new] += 1
        end = first

    out = [-1] * n
    following = list(range(n))
    done = bytearray(n)
    out[0] = n - 1
    done[n - 1] = 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[following[g]] = j
            following[g] += 1
            done[j] = 1
            j = prev[j]
    return np.array(out, np.int64)
