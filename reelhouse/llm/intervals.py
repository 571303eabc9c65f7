"""Which positions of a few megabytes of strings start a repeated string of a given length:
Burrows-Wheeler transform and breadth-first backward extension, on numpy arrays.

Suffixes are sorted as far as the length needs (windows of seven symbols, then doubling), each
string ending in a terminator of its own.  The interval of a string w holds the suffixes that
start with w.  Extending every interval by one symbol to the left, shortest strings first, gives
the boundaries between neighbouring suffixes in order of their common prefix: an interval of a
string of length l + 1 whose right boundary is still unknown settles it at l, and is extended
further; any other is dropped.  The expansion ends at the minimum length: the boundaries that are
unknown then are those whose neighbours share that many symbols or more.
"""

from __future__ import annotations

import numpy as np

WIDE = 64   # intervals of more suffixes are extended symbol by symbol, smaller ones suffix by suffix


def sorted_suffixes(text: np.ndarray, length: int) -> np.ndarray:
    """Start positions of the suffixes of ``text`` (symbols from 1, terminators 0), sorted by
    their first ``length`` symbols at least; a terminator sorts by its position."""
    n = len(text)
    key, on, h = text.astype(np.int64), text != 0, 7
    for step in range(1, h):
        shifted = np.zeros(n, dtype=np.int64)
        shifted[:-step] = text[step:]
        key = (key << 9) | np.where(on, shifted, 0)
        on &= shifted != 0
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.ones(n, dtype=bool)
    # a key that ends in 0 holds a terminator: no other suffix is equal
    head[1:] = (sorted_key[1:] != sorted_key[:-1]) | (sorted_key[1:] & 511 == 0)
    del key, on, sorted_key
    rank = np.empty(n, dtype=np.int64)
    slot = np.flatnonzero(head)
    rank[order] = np.repeat(slot, np.diff(slot, append=n))
    while h < length:
        tied = ~head
        tied[:-1] |= ~head[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        at = order[slots]
        pair = rank[at] * n + rank[at + h]
        by = np.argsort(pair, kind="stable")
        at, pair = at[by], pair[by]
        order[slots] = at
        new = np.ones(len(at), dtype=bool)
        new[1:] = pair[1:] != pair[:-1]
        head[slots] = new
        first = np.flatnonzero(new)
        rank[at] = np.repeat(slots[first], np.diff(first, append=len(at)))
        h *= 2
    return order


def unsettled(order: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """Boundaries j between suffixes ``order[j - 1]`` and ``order[j]`` whose common prefix has
    ``length`` symbols or more."""
    n = len(text)
    before = text[order - 1].astype(np.int64)   # the transform; position 0 follows the last terminator
    by_symbol = np.argsort(before, kind="stable")
    ranked = before[by_symbol] * n + by_symbol  # sorted: a rank is one search
    step = np.empty(n, dtype=np.int64)
    step[by_symbol] = np.arange(n)
    used = np.unique(before[before > 0])
    known = np.zeros(n + 1, dtype=bool)
    known[[0, n]] = True
    # strings of one symbol; each terminator is a symbol of its own
    ends = np.searchsorted(ranked, [c * n for c in [0, *used.tolist(), 512]])
    n_ends = int(ends[1])
    low = np.concatenate([np.arange(n_ends), ends[1:-1]])
    high = np.concatenate([np.arange(1, n_ends + 1), ends[2:]])
    for _ in range(length):
        new = ~known[high]
        low, high = low[new], high[new]
        if not len(low):
            break
        known[high] = True
        size = high - low
        # suffixes of an interval with the same symbol before them stay neighbours
        one, two = low[size == 1], low[size == 2]
        same = before[two] == before[two + 1]
        pair, one = two[same], np.concatenate([one, two[~same], two[~same] + 1])
        one, pair = step[one[before[one] > 0]], step[pair[before[pair] > 0]]
        lows, highs = [one, pair], [one + 1, pair + 2]
        many = size > 2
        if many.any():
            low, high, size = low[many], high[many], size[many]
            narrow, wide = np.flatnonzero(size <= WIDE), np.flatnonzero(size > WIDE)
            ends = np.cumsum(size[narrow])
            member = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low[narrow] - ends + size[narrow], size[narrow])
            symbols, first, n_same = np.unique(np.repeat(narrow, size[narrow]) * 512 + before[member],
                                               return_index=True, return_counts=True)
            on = symbols & 511 > 0
            a = step[member[first[on]]]
            lows.append(a)
            highs.append(a + n_same[on])
            if len(wide):
                symbol = np.tile(used, len(wide)) * n
                a = np.searchsorted(ranked, symbol + np.repeat(low[wide], len(used)))
                b = np.searchsorted(ranked, symbol + np.repeat(high[wide], len(used)))
                lows.append(a[a < b])
                highs.append(b[a < b])
        low, high = np.concatenate(lows), np.concatenate(highs)
    return np.flatnonzero(~known)


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, a mask over its first ``len - length + 1`` positions: whether the
    ``length`` bytes there start anywhere else in the strings."""
    sizes = np.array([len(s) + 1 for s in strings], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8).astype(np.int16) + 1
    text[starts + sizes - 1] = 0
    order = sorted_suffixes(text, length)
    known = unsettled(order, text, length)
    repeated = np.zeros(len(text), dtype=bool)
    repeated[order[known]] = repeated[order[known - 1]] = True
    return [repeated[a:a + len(s) - length + 1] for a, s in zip(starts, strings)]
