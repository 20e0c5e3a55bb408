"""FM-index over word numbers: a wavelet matrix on packed bits, searched for many at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """Bit row in 64-bit words with a running count of ones per word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]).astype(np.int32)
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones stand before each position."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class FMIndex:
    """Index of `text` (numbers from 0), for patterns of up to `depth` numbers.

    Suffixes are sorted by their first `depth` numbers only, which is all that such
    patterns can see; the last column is kept as one bit row per binary digit.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        self.order = _sorted_suffixes(text, depth)
        last = text[self.order - 1]
        self.levels: list[tuple[int, Bits]] = []
        top = int(text.max()) if n else 0
        symbols = np.arange(top + 1)
        begin = np.zeros(top + 1, np.int64)
        for shift in reversed(range(max(1, top.bit_length()))):
            bit = (last >> shift) & 1
            row = Bits(bit == 1)
            self.levels.append((shift, row))
            ones = row.ones(begin)
            begin = np.where((symbols >> shift) & 1, row.zeros + ones, begin - ones)
            last = np.concatenate([last[bit == 0], last[bit == 1]])
        # A symbol's place in the first column, less its place below the last bit row.
        counts = np.bincount(text, minlength=top + 1)
        self.base = np.cumsum(counts) - counts - begin

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of symbol + pattern from those of the patterns."""
        at = np.concatenate([low, high])
        twice = np.concatenate([symbol, symbol])
        for shift, row in self.levels:
            ones = row.ones(at)
            at = np.where((twice >> shift) & 1, row.zeros + ones, at - ones)
        at += self.base[twice]
        return at[:len(low)], at[len(low):]


def _sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order by the first `depth` numbers or more, by doubling.

    The first key packs as many numbers as 62 bits hold. Suffixes that agree stay in any order.
    """
    n = len(text)
    bits = (int(text.max(initial=0)) + 1).bit_length()
    span = max(1, min(62 // bits, depth))
    key = np.zeros(n, np.int64)
    for ahead in range(span):
        key <<= bits
        key[:max(0, n - ahead)] |= text[ahead:] + 1
    order, rank = _ranked(key)
    while span < depth:
        follow = np.zeros(n, np.int64)
        follow[:max(0, n - span)] = rank[span:] + 1
        order, rank = _ranked(rank * (int(follow.max(initial=0)) + 1) + follow)
        span *= 2
        if n and rank[order[-1]] == n - 1:
            break
    return order


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and each key's number among the distinct ones."""
    order = np.argsort(key)
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.diff(key[order], prepend=key[order[:1]]) != 0)
    return order, rank


def repeated_windows(pieces: list[np.ndarray], weights: np.ndarray, window: int) -> list[np.ndarray]:
    """For every piece, which of its windows occur twice or more among all pieces.

    pieces hold numbers from 1; weights say how often a piece stands in the corpus. All pieces
    go through the index together, each from left to right. A search runs from a window's end to
    the left: what stops it (a stretch found once) rules out every window around that stretch, and
    one that runs on past the window's start settles the windows in between, so searches leap ahead
    while they succeed.
    """
    lengths = np.array([len(p) for p in pieces], np.int64)
    text = np.concatenate([np.concatenate([p, [0]]) for p in pieces]).astype(np.int64)
    begin = np.cumsum(lengths + 1) - lengths - 1
    index = FMIndex(text, 2 * window)
    owner = np.repeat(np.arange(len(pieces)), lengths + 1)
    heavy = np.concatenate([[0], np.cumsum(np.asarray(weights, np.int64)[owner][index.order])])
    final = lengths - window
    found = [np.zeros(max(0, f + 1), bool) for f in final]
    for i in np.flatnonzero((np.asarray(weights) > 1) & (final >= 0)):
        found[i][:] = True
    todo = np.flatnonzero((final >= 0) & (np.asarray(weights) == 1))
    done = np.full(len(todo), -1, np.int64)   # last settled window
    leap = np.ones(len(todo), np.int64)
    n = len(text)

    def probe(at):
        goal = np.minimum(done[at] + leap[at], final[todo[at]])
        return goal

    goal = probe(np.arange(len(todo)))
    place = goal + window                     # next number to the left stands at place - 1
    low, high = np.zeros(len(todo), np.int64), np.full(len(todo), n, np.int64)
    live = np.arange(len(todo))
    while len(live):
        symbol = text[begin[todo[live]] + place[live] - 1]
        lo, hi = index.step(symbol, low[live], high[live])
        ok = heavy[hi] - heavy[lo] >= 2
        low[live], high[live] = lo, hi
        place[live[ok]] -= 1
        reached = live[ok][place[live[ok]] == done[live[ok]] + 1]
        for i in reached:
            found[todo[i]][done[i] + 1:goal[i] + 1] = True
        done[reached] = goal[reached]
        leap[reached] = np.minimum(2 * leap[reached], window)
        failed = live[~ok]
        near = leap[failed] == 1
        # The number at place - 1 stopped it: windows up to there are found once.
        done[failed[near]] = place[failed[near]] - 1
        leap[failed[~near]] //= 2
        again = np.concatenate([reached, failed])
        goal[again] = probe(again)
        place[again] = goal[again] + window
        low[again], high[again] = 0, n
        live = live[done[live] < final[todo[live]]]
    return found
