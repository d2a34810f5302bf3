"""Longest common prefixes up to a bound, by breadth-first backward extension on a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of `symbols` (small non-negative integers) sorted by their first `depth` symbols or more.

    Ranks of 4-symbol prefixes are doubled until they cover `depth` or are all different.
    """
    n = len(symbols)
    base = np.int64(symbols.max(initial=0) + 2)
    padded = np.concatenate([symbols.astype(np.int64) + 1, np.zeros(3, np.int64)])
    key = ((padded[:n] * base + padded[1 : n + 1]) * base + padded[2 : n + 2]) * base + padded[3 : n + 3]
    length = 4
    while True:
        order = np.argsort(key)  # what is equal up to `depth` may stand in any order
        ranked = key[order]
        step = np.ones(n, np.int32)
        step[1:] = ranked[1:] != ranked[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step, dtype=np.int64)
        if length >= depth or n == 0 or rank[order[-1]] == n:
            return order
        after = np.zeros(n, np.int64)
        after[: max(n - length, 0)] = rank[length:]
        key = rank * np.int64(n + 1) + after
        length *= 2


def in_order(values: np.ndarray) -> np.ndarray:
    """A stable argsort of non-negative integers below 2^31: value and place are sorted as one number."""
    n = np.int64(max(1, len(values)))
    return np.sort(values.astype(np.int64) * n + np.arange(len(values))) % n


def long_prefixes(symbols: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Whether each suffix in `order` shares at least `least` symbols with the one before it.

    Level l holds the boundaries between neighbours whose common prefix has length l. Two neighbouring occurrences of a symbol c in
    the transform map to neighbouring suffixes c..., whose common prefix is one longer than the shortest between the two: the level
    of the first boundary that separates them. So boundaries of level l give those of level l + 1, every boundary is set once, and
    what no level below `least` sets is long enough.
    """
    n = len(order)
    first = symbols[order]
    fresh = np.ones(n, bool)
    fresh[1:] = first[1:] != first[:-1]
    transform = symbols[order - 1]  # the symbol before each suffix; the whole text counts as a cycle, and its ends are separators
    by_symbol = in_order(transform)
    same = transform[by_symbol[1:]] == transform[by_symbol[:-1]]
    left, right = by_symbol[:-1][same], by_symbol[1:][same]
    # place of the right one among all suffixes: symbols before it in order, plus equal ones before it
    target = np.flatnonzero(np.concatenate([[False], same]))
    by_place = in_order(left)
    left, right, target = left[by_place].astype(np.int32), right[by_place].astype(np.int32), target[by_place].astype(np.int32)
    unset = np.ones(n, bool)
    unset[fresh] = False
    passed = np.empty(n, np.int32)
    open_pairs = unset[target]
    left, right, target = left[open_pairs], right[open_pairs], target[open_pairs]
    for _ in range(1, least):
        if not fresh.any() or not len(left):
            break
        np.cumsum(fresh, out=passed)
        parted = passed[right] > passed[left]
        fresh[:] = False
        fresh[target[parted]] = True
        unset[target[parted]] = False
        together = ~parted
        left, right, target = left[together], right[together], target[together]
    return unset
