"""Linear suffix sorting by grouping on Lyndon prefixes.

First pass: suffixes are grouped by their first symbol, and groups are processed in
descending order. Each suffix of the current group points at the nearest earlier suffix
of a smaller group (its previous smaller suffix). The suffixes pointed at gain the
group's string as many times as they are pointed at, so they leave their group for new
ones directly above it. In the end a group holds the suffixes with one Lyndon prefix.

Second pass: suffixes of one group are ordered by the suffix that follows their Lyndon
prefix. Walking the result in ascending order, each emitted suffix releases the chain of
previous-smaller pointers that starts left of it. Nothing is renamed or sorted again.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(symbols: Sequence[int] | np.ndarray) -> np.ndarray:
    """Suffix array of non-negative integers; the end of the text is smaller than any symbol."""
    values = np.asarray(symbols, dtype=np.int64)
    n = len(values) + 1
    text = np.zeros(n, np.int64)
    text[:-1] = values + 1
    order = np.argsort(text, kind="stable")
    ranked = text[order]
    heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    sizes = np.diff(np.append(heads, n))
    start = np.empty(n, np.int64)
    start[order] = np.repeat(heads, sizes)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    group = start.tolist()
    group.append(-1)  # what index -1 reads: smaller than every group
    size = [0] * n
    for head, count in zip(heads.tolist(), sizes.tolist()):
        size[head] = count
    pool = order.tolist()
    at = place.tolist()
    previous = [-1] * n

    top = n - 1
    while top > 0:
        low = group[pool[top]]
        if low == top:  # a group of one
            suffix = pool[top]
            j = suffix - 1
            while group[j] >= low:
                j = previous[j]
            previous[suffix] = j
            if j >= 0 and size[group[j]] > 1:
                _raise([j], group, size, pool, at)
        else:
            times: dict[int, int] = {}
            for suffix in sorted(pool[low : top + 1]):
                j = suffix - 1
                while group[j] >= low:
                    j = previous[j]
                previous[suffix] = j
                times[j] = times.get(j, 0) + 1
            times.pop(-1, None)
            by_count: dict[int, list[int]] = {}
            for j, count in times.items():
                by_count.setdefault(count, []).append(j)
            for count in sorted(by_count, reverse=True):
                _raise(by_count[count], group, size, pool, at)
        top = low - 1

    result = [-1] * n
    result[0] = n - 1
    free = list(range(n))  # next free place of a group, by its start
    done = bytearray(n + 1)
    done[n - 1] = 1
    done[n] = 1  # index -1
    for rank in range(n):
        j = result[rank] - 1
        while not done[j]:
            done[j] = 1
            head = group[j]
            result[free[head]] = j
            free[head] += 1
            j = previous[j]
    return np.array(result[1:], np.int64)


def _raise(members: list[int], group: list[int], size: list[int], pool: list[int], at: list[int]) -> None:
    """Move suffixes into new groups, each directly above the group its members come from."""
    moved: dict[int, int] = {}
    for j in members:
        head = group[j]
        taken = moved.get(head, 0)
        moved[head] = taken + 1
        goal = head + size[head] - 1 - taken
        here = at[j]
        other = pool[goal]
        pool[here], pool[goal] = other, j
        at[other], at[j] = here, goal
    for head, taken in moved.items():
        left = size[head] - taken
        if left:
            size[head] = left
            fresh = head + left
            size[fresh] = taken
            for k in range(fresh, fresh + taken):
                group[pool[k]] = fresh


def common_prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes (at most ``depth``) that neighbours in ``order`` share; entry 0 is 0.

    ``starts`` and ``ends`` bound each suffix in ``data``.
    """
    n = len(order)
    shared = np.zeros(n, np.int64)
    if n < 2:
        return shared
    padded = np.concatenate([data, np.zeros(depth + 16, np.uint8)])
    words = np.zeros(len(padded) - 7, np.uint64)
    for k in range(8):
        words |= padded[k : len(words) + k].astype(np.uint64) << np.uint64(8 * k)
    a, b = starts[order[:-1]], starts[order[1:]]
    most = np.minimum(np.minimum(ends[order[:-1]] - a, ends[order[1:]] - b), depth)
    live = np.arange(n - 1)
    for step in range(0, depth, 8):
        differ = words[a[live] + step] ^ words[b[live] + step]
        same = differ == 0
        odd = ~same
        bits = differ[odd]
        lowest = np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
        shared[1:][live[odd]] = step + lowest
        shared[1:][live[same]] = step + 8
        live = live[same & (most[live] > step + 8)]
        if not len(live):
            break
    shared[1:] = np.minimum(shared[1:], most)
    return shared
