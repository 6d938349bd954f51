"""Repeated word sequences inside texts, by suffix arrays of many texts at once."""

from __future__ import annotations

import numpy as np

WINDOW = 3


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every element where its value's run starts in sorted order, and how many elements equal it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    sizes = np.diff(np.append(heads, len(keys)))
    rank, count = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    rank[order], count[order] = np.repeat(heads, sizes), np.repeat(sizes, sizes)
    return rank, count


def _follower(rank: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The ranks at some places, 0 beyond the end of the text, else from 1."""
    inside = at < ends
    return np.where(inside, rank[np.where(inside, at, 0)] + 1, 0)


def repeats(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every word, whether it lies in a window of three words that its text has at least twice, and the
    length of the longest sequence that starts with it and that its text has at least twice (0 if under three).

    codes: the words as numbers; starts: where each text starts, and the end. Suffixes are ranked by three words;
    those whose first three words repeat are ranked by twice as many words again and again, each group in the
    slots it holds in the suffix array. The ranks kept from each step then give the common prefix of neighbours in the
    array: of the intervals of common prefixes, the deepest with a suffix in it is as deep as the closer neighbour.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, bool), np.zeros(0, np.int64)
    lengths = np.diff(starts)
    end, place = np.repeat(starts[1:], lengths), np.arange(n)
    text = np.repeat(np.arange(len(lengths)), lengths)
    first, _ = _numbered(text * (int(codes.max()) + 1) + codes)
    second, _ = _numbered(first * (n + 1) + _follower(first, place + 1, end))
    rank, count = _numbered(second * (n + 1) + _follower(first, place + 2, end))
    suffixes = np.flatnonzero((count > 1) & (place + WINDOW <= end))
    covered = np.zeros(n, bool)
    for i in range(WINDOW):
        covered[suffixes + i] = True
    longest = np.zeros(n, np.int64)
    if not len(suffixes):
        return covered, longest
    steps, active, width = [], suffixes, WINDOW
    while len(active):
        steps.append((width, rank))
        rank = rank.copy()
        slot = rank[active]
        keys = slot * (n + 1) + _follower(rank, active + width, end[active])
        order = np.argsort(keys, kind="stable")
        keys, slot, moved = keys[order], slot[order], active[order]
        new_group = np.concatenate(([True], slot[1:] != slot[:-1]))
        new_key = np.concatenate(([True], keys[1:] != keys[:-1]))
        index = np.arange(len(moved))
        in_group = index - np.maximum.accumulate(np.where(new_group, index, 0))
        rank[moved] = slot + np.maximum.accumulate(np.where(new_key, index, 0)) - (index - in_group)
        sizes = np.diff(np.append(np.flatnonzero(new_key), len(moved)))
        active = moved[np.repeat(sizes, sizes) > 1]
        width *= 2
    array = suffixes[np.argsort(rank[suffixes], kind="stable")]
    a, b = array[:-1], array[1:]
    common = np.zeros(len(a), np.int64)
    for width, ranks in [*reversed(steps), (2, second), (1, first)]:
        fits = (a + common + width <= end[a]) & (b + common + width <= end[b]) & (text[a] == text[b])
        left, right = np.where(fits, a + common, 0), np.where(fits, b + common, 0)
        common += np.where(fits & (ranks[left] == ranks[right]), width, 0)
    common[common < WINDOW] = 0
    longest[a] = common
    longest[b] = np.maximum(longest[b], common)
    return covered, longest


def union_lengths(lengths: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    """How many words of each text the spans of at least `least` words cover that start at its words."""
    n = len(lengths)
    long = np.flatnonzero(lengths >= least)
    change = np.bincount(long, minlength=n + 1)[: n + 1] - np.bincount(long + lengths[long], minlength=n + 1)[: n + 1]
    inside = np.concatenate(([0], np.cumsum(np.cumsum(change)[:n] > 0)))
    return inside[starts[1:]] - inside[starts[:-1]]
