"""Burrows-Wheeler transforms of integer sequences: suffix order, wavelet ranks, FM-index.

All steps are array operations over one shard, whose size the callers bound.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, depth: int, groups: bool = False):
    """Positions sorted by their first ``depth`` symbols or more, ties in any order.

    Prefix doubling: ranks by 1, 2, 4, ... symbols; positions whose rank is
    already unique are left out of later rounds. Beyond the end stands a symbol
    smaller than all.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    fresh = np.empty(n, bool)
    if n:
        fresh[0] = True
        np.not_equal(ranked[1:], ranked[:-1], out=fresh[1:])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]  # a group's first place
    h = 1
    while h < depth:
        single = fresh & np.append(fresh[1:], True)
        at = np.flatnonzero(~single)  # places in groups of two or more
        if not len(at):
            break
        pos = order[at]
        group = rank[pos]
        ahead = pos + h
        after = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        # places of a group are consecutive, so sorting by (group, after) keeps groups in place
        by = np.argsort(group * (n + 1) + after)
        pos, group, after = pos[by], group[by], after[by]
        order[at] = pos
        new = np.ones(len(at), bool)
        new[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        fresh[at] = new
        rank[pos] = at[np.flatnonzero(new)[np.cumsum(new) - 1]]
        h *= 2
    return (order, rank) if groups else order


class WaveletMatrix:
    """Ranks of any symbol in prefixes of a sequence, a bit level at a time."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.n = bits, len(values)
        self.ones: list[np.ndarray] = []  # per level: ones before each place
        self.zeros: list[int] = []
        v = values.astype(np.int64)
        for level in range(bits - 1, -1, -1):
            bit = (v >> level) & 1
            ones = np.zeros(self.n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(self.n - int(ones[-1]))
            b = bit.astype(bool)
            v = np.concatenate([v[~b], v[b]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol[i]`` before ``place[i]``."""
        lo, hi = np.zeros_like(place), place
        for k in range(self.bits):
            ones, zeros = self.ones[k], self.zeros[k]
            bit = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            a, b = ones[lo].astype(np.int64), ones[hi].astype(np.int64)
            lo, hi = np.where(bit, zeros + a, lo - a), np.where(bit, zeros + b, hi - b)
        return hi - lo

    def access_rank(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it stands before that place."""
        symbol, lo, hi = np.zeros_like(place), np.zeros_like(place), place
        for k in range(self.bits):
            ones, zeros = self.ones[k], self.zeros[k]
            a, b = ones[lo].astype(np.int64), ones[hi].astype(np.int64)
            bit = ones[hi + 1] > ones[hi]
            symbol = (symbol << 1) | bit
            lo, hi = np.where(bit, zeros + a, lo - a), np.where(bit, zeros + b, hi - b)
        return symbol, hi - lo

    def branch(self, lo: np.ndarray, hi: np.ndarray, tag: np.ndarray):
        """All symbols inside each interval: (tag, symbol, rank at lo, rank at hi) by one descent."""
        start = np.zeros_like(lo)
        symbol = np.zeros_like(lo)
        for k in range(self.bits):
            ones, zeros = self.ones[k], self.zeros[k]
            s, a, b = (ones[x].astype(np.int64) for x in (start, lo, hi))
            left, right = np.flatnonzero((hi - b) > (lo - a)), np.flatnonzero(b > a)
            tag = np.concatenate([tag[left], tag[right]])
            symbol = np.concatenate([symbol[left] << 1, (symbol[right] << 1) | 1])
            start = np.concatenate([(start - s)[left], zeros + s[right]])
            lo, hi = np.concatenate([(lo - a)[left], zeros + a[right]]), np.concatenate([(hi - b)[left], zeros + b[right]])
        return tag, symbol, lo - start, hi - start


class FMIndex:
    """Index of a sequence of symbols >= 0; 0 separates texts and is in no pattern."""

    def __init__(self, symbols: np.ndarray, sample: int = 8):
        self.n = len(symbols)
        bits = max(1, int(symbols.max(initial=0)).bit_length())
        # sorted to the end: stepping back from one suffix to the next needs every tie resolved
        order = suffix_order(symbols, self.n)
        last = symbols[order - 1] if self.n else symbols
        self.wavelet = WaveletMatrix(last, bits)
        count = np.bincount(symbols, minlength=1 << bits)
        self.first = np.cumsum(count) - count
        # sampled suffix positions: every sample-th position, and each one after a separator,
        # so that no step back leaves a text
        kept = (order % sample == 0) | (last == 0)
        self.marks = np.zeros(self.n + 1, np.int64)
        np.cumsum(kept, out=self.marks[1:])
        self.positions = order[kept]

    def search(self, patterns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all patterns at once: suffix intervals [lo, hi)."""
        count = len(patterns)
        size = np.fromiter(map(len, patterns), np.int64, count)
        lo, hi = np.zeros(count, np.int64), np.full(count, self.n, np.int64)
        longest = int(size.max(initial=0))
        table = np.zeros((count, longest), np.int64)
        for i, p in enumerate(patterns):
            table[i, : len(p)] = p[::-1]
        for step in range(longest):
            at = np.flatnonzero((size > step) & (hi > lo))
            if not len(at):
                break
            c = table[at, step]
            known = c < len(self.first)
            hi[at[~known]] = lo[at[~known]]
            at, c = at[known], c[known]
            lo[at], hi[at] = self.first[c] + self.wavelet.rank(c, lo[at]), self.first[c] + self.wavelet.rank(c, hi[at])
        return lo, hi

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Text positions of suffix places: step back to a sampled position."""
        out, steps = np.zeros(len(places), np.int64), 0
        at, place = np.arange(len(places)), places.astype(np.int64)
        while len(at):
            found = self.marks[place + 1] > self.marks[place]
            out[at[found]] = self.positions[self.marks[place[found]]] + steps
            at, place = at[~found], place[~found]
            symbol, before = self.wavelet.access_rank(place)
            place = self.first[symbol] + before
            steps += 1
        return out
