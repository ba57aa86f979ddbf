"""Names for runs and pairs of words, round by round, so that equal passages get equal symbols inside.

A round replaces every maximal run of a symbol by one symbol, and then every pair of a left
symbol followed by a right symbol, where a bit of a symbol's name tells its side. A name is a
hash of what it stands for, so all tasks name a run or a pair alike, whatever text it is found in.
What a window of words holds settles all symbols in it but those near its ends, where a run may go
on or a partner may stand outside: equal windows share their inner symbols at equal places.
"""

from __future__ import annotations

import numpy as np

#: Bits of a place among the symbols of a chunk, below the leading bits of a name.
PLACE = 24
_LOW = np.uint64((1 << PLACE) - 1)
_BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Well spread 64-bit values, another function for each salt."""
    x = x + np.uint64(salt * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Spans:
    """64-bit hashes of any spans of a text, from one pass over its bytes."""

    _power = _inverse = np.ones(0, np.uint64)
    _values = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if n > len(Spans._power):
            size = max(n, 1 << 16)
            Spans._power = np.cumprod(np.full(size, _BASE, np.uint64))
            Spans._inverse = np.cumprod(np.full(size, pow(_BASE, -1, 1 << 64), np.uint64))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self._values[data] * self._power[:n], out=self.sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self._inverse[begin], 1)


def _runs(names: np.ndarray, bars: np.ndarray) -> np.ndarray:
    """Whether a maximal run begins at each symbol; a bar is always alone."""
    begins = np.ones(len(names), bool)
    begins[1:] = (names[1:] != names[:-1]) | bars[1:] | bars[:-1]
    return begins


class _Leftmost:
    """Place of the least name in ranges of symbols, the leftmost of those that agree in their leading bits."""

    def __init__(self, names: np.ndarray, widest: int):
        self.tables = [(names & ~_LOW) | np.arange(len(names), dtype=np.uint64)]
        while 2 << len(self.tables) <= 2 * widest:
            last, step = self.tables[-1], 1 << (len(self.tables) - 1)
            self.tables.append(np.minimum(last[:-step], last[step:]) if len(last) > step else last)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = np.frexp((end - begin).astype(np.float64))[1] - 1
        found = np.empty(len(begin), np.uint64)
        for k in np.unique(size):
            own = size == k
            table = self.tables[k]
            found[own] = np.minimum(table[begin[own]], table[end[own] - (1 << int(k))])
        return (found & _LOW).astype(np.int64)


def anchors(words: np.ndarray, bars: np.ndarray, first: np.ndarray, width: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(name, place in words) of the symbol that stands for each window of ``width`` words.

    ``first`` holds the windows' first words; no window holds a bar. The symbol is one of the highest
    round at which the window settles any, so both are the same for equal windows.
    """
    names, own_bars = words, bars
    at = np.arange(len(words) + 1)  # first word of every symbol
    begin, end = first, first + width  # settled symbols of each window
    open_ = np.arange(len(first))
    name, place = np.empty(len(first), np.uint64), np.empty(len(first), np.int64)

    def settle(which: np.ndarray, level: int) -> None:
        if len(which):
            begins, ends = begin[which], end[which]
            found = _Leftmost(names, int((ends - begins).max()))(begins, ends)
            name[open_[which]] = mixed(names[found], 1000 + level)
            place[open_[which]] = at[found]

    for level in range(rounds):
        begins = _runs(names, own_bars)
        heads = np.flatnonzero(begins)
        length = np.diff(heads, append=len(names))
        run_of = np.cumsum(begins) - 1
        after = names[heads]
        many = length > 1
        after[many] = mixed(after[many] ^ mixed(length[many].astype(np.uint64), 2), 3)
        bar = own_bars[heads]
        right = (mixed(after, 10 + level) & np.uint64(1)).astype(bool) & ~bar
        left = ~right & ~bar
        leads = np.zeros(len(after), bool)  # first symbol of a pair
        leads[:-1] = left[:-1] & right[1:]
        starts = np.ones(len(after), bool)
        starts[1:] = ~leads[:-1]
        item_of = np.cumsum(starts) - 1
        item_of = np.append(item_of, item_of[-1] + 1)
        kept = np.flatnonzero(starts)
        paired = after[kept]
        two = leads[kept]
        paired[two] = mixed(mixed(paired[two], 4) + after[kept[two] + 1], 5)

        low, high = run_of[begin] + 1, run_of[end - 1]
        inside = low < high
        new_begin, new_end = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        low, high = low[inside], high[inside]
        new_begin[inside] = item_of[low + right[low]]
        new_end[inside] = item_of[high - left[high - 1]]
        on = new_begin < new_end
        settle(np.flatnonzero(~on), level)
        open_, begin, end = open_[on], new_begin[on], new_end[on]
        at = np.append(at[heads][kept], at[-1])
        names, own_bars = paired, bar[kept]
        if not len(open_):
            break
    else:
        settle(np.arange(len(open_)), rounds)
    return name, place
