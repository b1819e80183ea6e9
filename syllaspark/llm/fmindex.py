"""A compressed full-text index over sequences of numbers: suffix order, wavelet matrix, backward search."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit string in 64-bit words with a count before each word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros(n // 64 * 64 + 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64))[:-1].astype(np.uint32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """How many of the first i bits are set."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """Rank of any symbol over a sequence of small numbers, one bit string for each bit of the symbols."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.depth = max(1, int(symbols - 1).bit_length())
        self.levels = []
        now = sequence
        for k in range(self.depth - 1, -1, -1):
            bit = (now >> k) & 1
            self.levels.append((Bits(bit), int(len(now) - bit.sum())))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        self.first = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(self.levels):
            ones = bits.ones(i)
            i = np.where((symbol >> (self.depth - 1 - k)) & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the first i places."""
        return self._descend(symbol, i) - self.first[symbol]


class FmIndex:
    """An index of many sequences, given end to end; a separator of its own ends each.

    Suffixes are ordered by their first ``limit`` symbols, which is enough to search
    patterns of up to that many.
    """

    def __init__(self, flat: np.ndarray, sizes: np.ndarray, limit: int):
        m = len(sizes)
        self.alphabet, symbol = np.unique(flat, return_inverse=True)
        ends = np.cumsum(sizes)
        of = np.repeat(np.arange(m), sizes)
        text = np.empty(len(flat) + m, np.int64)
        self.place = np.arange(len(flat)) + of  # where each symbol stands
        text[self.place] = symbol + m
        text[ends + np.arange(m)] = np.arange(m)
        n = len(text)
        rank, width, longest = text.copy(), 1, min(limit, int(sizes.max()) + 1 if m else 1)
        order = np.argsort(rank)
        while width < longest:  # prefix doubling; separators differ, so no common prefix is longer than a sequence
            after = np.zeros(n, np.int64)
            after[: n - width] = rank[width:] + 1
            both = rank * (n + m + 2 + len(self.alphabet)) + after
            order = np.argsort(both)
            now = both[order]
            step = np.append(0, np.cumsum(now[1:] != now[:-1]))
            rank[order] = step
            width *= 2
        self.order = order
        self.size, self.symbols = n, m + len(self.alphabet)
        self.sequence_of = np.searchsorted(ends + np.arange(m), order)
        self.wavelet = Wavelet(text[order - 1], self.symbols)
        self.before = np.append(0, np.cumsum(np.bincount(text, minlength=self.symbols)))[:-1]
        self.symbol = symbol + m

    def statistics(self, last: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of places of the flat input: (length, interval's ends).

        The length is that of the longest run of symbols that ends at a place and occurs
        elsewhere too, up to ``limit``; the interval is of that run's suffixes.  A search
        stops where a place's own occurrence is the only one left.
        """
        low, high = np.zeros(len(last), np.int64), np.full(len(last), self.size, np.int64)
        length, live = np.zeros(len(last), np.int64), np.arange(len(last))
        for k in range(limit):
            c = self.symbol[last[live] - k]
            a = self.before[c] + self.wavelet.rank(c, low[live])
            b = self.before[c] + self.wavelet.rank(c, high[live])
            more = b - a > 1
            live = live[more]
            if not len(live):
                break
            low[live], high[live] = a[more], b[more]
            length[live] += 1
        return length, low, high

    def least(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For each interval the least of the sequences' values in it; intervals of one length are disjoint or equal."""
        own = values[self.sequence_of]
        out = own[np.minimum(low, self.size - 1)]
        wide = np.flatnonzero(high - low > 1)
        if len(wide):
            starts, back = np.unique(low[wide], return_inverse=True)
            stops = np.zeros(len(starts), np.int64)
            stops[back] = high[wide]
            cut = np.column_stack([starts, stops]).ravel()
            out[wide] = np.minimum.reduceat(np.append(own, own[-1]), cut)[::2][back]
        return out
