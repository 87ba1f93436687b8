"""FM-index over one shard of integer symbols: suffix order, wavelet-matrix ranks, sampled suffix positions.

Symbol 0 is a separator that no search crosses; each separator counts as a sign of its own, in text
order, which makes all suffixes differ and the LF mapping exact.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that still tie are sorted again. text ends with 0."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    ordered = text[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1])) | (ordered == 0)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    alone = np.concatenate((new[1:], [True])) & new
    active, width = order[~alone], 1
    while len(active):
        key = rank[active] * n + rank[active + width]
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        group = key // n
        place = np.arange(len(key))
        first = np.maximum.accumulate(np.where(np.concatenate(([True], group[1:] != group[:-1])), place, 0))
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[active] = group + np.maximum.accumulate(np.where(new, place, 0)) - first
        alone = np.concatenate((new[1:], [True])) & new
        active, width = active[~alone], width * 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class Bits:
    """A bit vector with counts of ones before any place."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.zeros((n >> 6) + 1, np.uint64)
        raw = np.packbits(bits, bitorder="little")
        packed.view(np.uint8)[: len(raw)] = raw
        self.words, self.before = packed, np.concatenate(([0], np.cumsum(np.bitwise_count(packed)[:-1], dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int, sample: int = 16):
        """text: symbols 1 to symbols - 1, with 0 as separator, and 0 as its last."""
        order = suffix_order(text)
        self.bwt = text[order - 1]  # before the first stands the last, a separator
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols)))).astype(np.int64)
        self.levels: list[tuple[int, Bits, int]] = []
        now = self.bwt
        for shift in range(max(1, (symbols - 1).bit_length()) - 1, -1, -1):
            bits = (now >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bits), int(len(bits) - bits.sum())))
            now = np.concatenate((now[~bits], now[bits]))
        self.begin = self._down(np.arange(symbols), np.zeros(symbols, np.int64))
        kept = (order % sample == 0) | (self.bwt == 0)
        self.kept, self.marks, self.samples = kept, Bits(kept), order[kept]

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where(symbol >> shift & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbol stands in the first at places of the transformed text."""
        return self._down(symbol, at) - self.begin[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows low:high of the suffixes that begin with each pattern (one for each row of patterns)."""
        last = patterns[:, -1]
        low, high = self.first[last].copy(), self.first[last + 1].copy()
        live = np.flatnonzero(high > low)
        for k in range(patterns.shape[1] - 2, -1, -1):
            if not len(live):
                break
            sign = patterns[live, k]
            low[live] = self.first[sign] + self.rank(sign, low[live])
            high[live] = self.first[sign] + self.rank(sign, high[live])
            live = live[high[live] > low[live]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of rows: walk back to a sampled one."""
        out, steps = np.full(len(rows), -1, np.int64), 0
        left, at = np.arange(len(rows)), rows
        while len(left):
            known = self.kept[at]
            out[left[known]] = self.samples[self.marks.rank(at[known])] + steps
            left, at, steps = left[~known], at[~known], steps + 1
            sign = self.bwt[at]
            at = self.first[sign] + self.rank(sign, at)
        return out
