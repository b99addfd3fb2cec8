"""Suffix arrays of byte strings in numpy: Larsson-Sadakane refinement and Kasai common prefixes, both to a fixed depth."""

from __future__ import annotations

import numpy as np

_BLOCK = 256


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions in the order of the next ``depth`` bytes, and how many of these each surely shares with the one before.

    The first order is by eight bytes at once. Each round then looks at the groups that are still equal and sorts them by
    the group of the suffix as many bytes further on as are sorted already, which doubles the sorted depth. Neighbours
    that a round separates share what was sorted before it and less than twice as much.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[:n]).view(">u8")[:, 0].astype(np.uint64)
    order = np.argsort(eight)
    sorted_ = eight[order]
    fresh = np.ones(n, bool)
    fresh[1:] = sorted_[1:] != sorted_[:-1]
    shared = np.zeros(n, np.int64)
    # The number of a group is the place of its first member; past the end comes a group below all others.
    group = np.zeros(n + 1, np.int64)
    sorted_to = 8
    while True:
        first = np.flatnonzero(fresh)
        sizes = np.diff(np.append(first, n))
        group[order] = np.repeat(first + 1, sizes)
        open_ = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if sorted_to >= depth or not len(open_):
            shared[~fresh] = depth
            return order, shared
        members = order[open_]
        own = group[members]
        next_ = group[np.minimum(members + sorted_to, n)]
        by = np.argsort(own * (n + 2) + next_)
        order[open_] = members[by]
        own, next_ = own[by], next_[by]
        split = open_[1:][(own[1:] == own[:-1]) & (next_[1:] != next_[:-1])]
        fresh[split] = True
        shared[split] = sorted_to
        sorted_to *= 2


def common_prefixes(data: np.ndarray, order: np.ndarray, shared: np.ndarray, depth: int, wanted: int = 0) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in ``order``, at most ``depth``.

    Kasai's walk over text positions, in which a common prefix shrinks by one byte at most from one position to the next;
    many blocks of the text are walked in step. ``shared`` is what the sorting has found out, so the walk only has to
    look at pairs between one of its depths and the next. Pairs that cannot reach ``wanted`` keep ``shared``. As suffixes
    equal to the depth are in no order beyond it, the walk starts anew after them.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    known = np.empty(n, np.int64)
    known[order] = shared
    walked = (known < depth) & (before >= 0) & (np.maximum(2 * known, 8) > wanted)
    padded = np.concatenate([data.astype(np.int16), np.full(depth + 1, -1, np.int16)])
    starts = np.arange(0, n, _BLOCK)
    length = np.zeros(len(starts), np.int64)
    for step in range(min(_BLOCK, n)):
        at = starts + step
        if at[-1] >= n:
            starts, length, at = starts[:-1], length[:-1], at[:-1]
        here = walked[at]
        least = known[at]
        # A pair that was not walked, or that is equal to the depth, says nothing about the next one.
        length = np.where(here, np.maximum(length - 1, least), 0)
        going = np.flatnonzero(here & (length < depth))
        while len(going):
            a, b = at[going] + length[going], before[at[going]] + length[going]
            same = (padded[a] == padded[b]) & (np.maximum(a, b) < n)
            going = going[same]
            length[going] += 1
            going = going[length[going] < depth]
        known[at[here]] = length[here]
        length[length == depth] = 0
    return known[order]
