"""Repeated byte strings by interval expansion on a Burrows-Wheeler transform.

Common prefixes of neighbouring suffixes are derived breadth-first by increasing value, as in
building an LCP array from the transform alone, and the search stops at the length asked for:
what it has not reached by then is at least that long. No suffix of one text runs into another.
"""

from __future__ import annotations

import numpy as np

#: Bits of a place; blocks are shorter, so that two ranks and a place are sorted as one number.
PLACE = 21
#: Symbols compared at once when suffixes are first sorted.
_PACK = 4


def suffix_ranks(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rank of every suffix; ``ends`` are the places of the text ends, which differ and sort first, in order."""
    n = len(symbols)
    if n >> PLACE:
        raise ValueError(f"a block has at most {1 << PLACE} bytes")
    low = (1 << PLACE) - 1
    end_of = np.repeat(ends, np.diff(ends, prepend=-1))
    place = np.arange(n)
    packed = np.zeros(n, np.int64)
    for k in range(_PACK):
        packed = packed << 9 | np.where(place + k < end_of, symbols[np.minimum(place + k, n - 1)], 0)
    packed = np.sort(packed << PLACE | place)
    order = packed & low
    packed >>= PLACE
    closed = end_of[order] - order < _PACK
    new = np.ones(n, bool)
    new[1:] = (packed[1:] != packed[:-1]) | closed[1:] | closed[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    tied = ~new
    tied[:-1] |= tied[1:]
    open_, step = order[tied], _PACK
    while len(open_):
        key = np.sort(rank[open_] << 2 * PLACE | rank[open_ + step] << PLACE | open_)
        order, both, first = key & low, key >> PLACE, key >> 2 * PLACE
        at = np.arange(len(order))
        group, new = np.ones(len(order), bool), np.ones(len(order), bool)
        group[1:] = first[1:] != first[:-1]
        new[1:] = both[1:] != both[:-1]
        rank[order] = first + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        tied = ~new
        tied[:-1] |= tied[1:]
        open_ = order[tied]
        step *= 2
    return rank


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, the starts of its strings of ``length`` bytes that also start elsewhere in ``texts``."""
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes) - 1
    n = int(sizes.sum())
    symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int16) + 1
    symbols[ends] = 0
    rank = suffix_ranks(symbols, ends)
    suffix = np.empty(n, np.int64)
    suffix[rank] = np.arange(n)
    before = symbols[suffix - 1]
    back = rank[suffix - 1]
    by_symbol = np.argsort(before, kind="stable")
    same = before[by_symbol[1:]] == before[by_symbol[:-1]]
    following, previous = np.full(n, n), np.full(n, -1)
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    previous[by_symbol[1:][same]] = by_symbol[:-1][same]

    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    known[1 : len(texts) + 1] = True
    left, right = np.array([0]), np.array([n - 1])
    for value in range(length):
        width = right - left + 1
        inside = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(left, width)
        text = before[inside] > 0
        inside, low, high = inside[text], np.repeat(left, width)[text], np.repeat(right, width)[text]
        begin = np.sort(back[inside[previous[inside] < low]])
        end = np.sort(back[inside[following[inside] > high]])
        fresh = ~known[end + 1]
        left, right = begin[fresh], end[fresh]
        known[right + 1] = True
        if value == 0:
            left, right = (np.concatenate([np.arange(len(texts)), x]) for x in (left, right))
        if not len(left):
            break
    long = np.flatnonzero(~known[:n])
    starts = np.unique(np.concatenate([suffix[long], suffix[long - 1]]))
    where = np.searchsorted(ends, starts)
    cuts = np.searchsorted(where, np.arange(len(texts) + 1))
    first = ends - sizes + 1
    return [starts[a:b] - first[i] for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
