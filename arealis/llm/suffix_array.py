"""Suffix array by linear grouping: groups of equal Lyndon prefixes, then their order, without renaming or recursion."""

from __future__ import annotations

from collections.abc import Sequence


def lyndon_groups(text: Sequence[int]) -> tuple[list[int], list[int]]:
    """Group of each suffix (the first place of its group in the suffix array) and its pointer to the previous smaller group.

    ``text`` ends with a character that is smaller than all others.  Suffixes start grouped by first character.  Groups are
    taken from the highest down: each member points to the nearest earlier suffix of a lower group, and the suffixes so
    pointed to are lifted out of their groups to new ones right behind, those with more pointers further.
    """
    n = len(text)
    counts: dict[int, int] = {}
    for c in text:
        counts[c] = counts.get(c, 0) + 1
    start, at = {}, 0
    for c in sorted(counts):
        start[c] = at
        at += counts[c]
    group = [start[c] for c in text]
    end = [0] * (n + 1)  # by first place of a group
    place, members = dict(start), [0] * n
    where = [0] * n
    for i, c in enumerate(text):
        p = place[c]
        members[p], where[i], place[c] = i, p, p + 1
    for c, first in start.items():
        end[first] = first + counts[c]
    previous = [-1] * n
    high = n
    while high > 0:
        low = group[members[high - 1]]
        pointed: dict[int, int] = {}
        several = False
        for i in sorted(members[low:high]) if high - low > 1 else (members[low],):
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                if j in pointed:
                    pointed[j] += 1
                    several = True
                else:
                    pointed[j] = 1
        if several:
            by_count: dict[int, list[int]] = {}
            for j, count in pointed.items():
                by_count.setdefault(count, []).append(j)
            lots = [by_count[count] for count in sorted(by_count, reverse=True)]
        else:
            lots = [list(pointed)]
        for lot in lots:
            touched: dict[int, int] = {}
            for j in lot:
                g = group[j]
                last = end[g] - 1
                touched.setdefault(g, last + 1)
                other, p = members[last], where[j]
                members[p], where[other] = other, p
                members[last], where[j] = j, last
                end[g] = last
            for g, stop in touched.items():
                first = end[g]
                if first != g:
                    end[first] = stop
                else:  # the whole group was lifted: it stays where it is
                    end[g] = stop
            for j in lot:
                g = group[j]
                group[j] = end[g] if end[g] <= where[j] else g
        high = low
    return group, previous


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes in order; ``text`` ends with a character that is smaller than all others.

    The least suffix is known; the one before each emitted suffix, and then those that pointers lead to, are the next
    members of their groups.
    """
    n = len(text)
    group, previous = lyndon_groups(text)
    out = [-1] * n
    free = list(range(n))  # next place of each group
    placed = bytearray(n)
    if n:
        out[0] = n - 1
        placed[n - 1] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            p = free[g]
            free[g] = p + 1
            out[p] = s
            placed[s] = 1
            s = previous[s]
    return out
