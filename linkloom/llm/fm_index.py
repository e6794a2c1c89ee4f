"""FM-index over integer sequences: suffix array, wavelet matrix, backward search, locate."""

from __future__ import annotations

import numpy as np

#: Every so many positions of the sequence the index keeps a suffix position.
SAMPLE_EVERY = 16


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``seq``, by prefix doubling; the last symbol must be the only 0."""
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    width = 1
    while width < n:
        key = rank * (n + 1)
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = new
        if rank[order[-1]] == n - 1:
            break
        width *= 2
    return order


class RankBits:
    """Bits with constant-time counts of ones before a position."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros((self.n // 64 + 1) * 64, dtype=np.uint8)
        padded[: self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        self.zeros = self.n - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class WaveletMatrix:
    """Symbols by bit planes; rank and access take one step per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.depth = max(1, int(n_symbols - 1).bit_length())
        self.planes: list[RankBits] = []
        rest = symbols
        for level in range(self.depth - 1, -1, -1):
            bit = (rest >> level) & 1
            self.planes.append(RankBits(bit.astype(np.uint8)))
            rest = np.concatenate((rest[bit == 0], rest[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before position ``at``, elementwise."""
        low, high = np.zeros_like(at), at.copy()
        for level, plane in zip(range(self.depth - 1, -1, -1), self.planes, strict=True):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = plane.ones(low), plane.ones(high)
            low = np.where(one, plane.zeros + a, low - a)
            high = np.where(one, plane.zeros + b, high - b)
        return high - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and how often it stands before it."""
        symbol, low, high = np.zeros_like(at), np.zeros_like(at), at.copy()
        for plane in self.planes:
            bit = plane.get(high)
            one = bit.astype(bool)
            a, b = plane.ones(low), plane.ones(high)
            low = np.where(one, plane.zeros + a, low - a)
            high = np.where(one, plane.zeros + b, high - b)
            symbol = symbol * 2 + bit
        return symbol, high - low


class FMIndex:
    """Finds every occurrence of many patterns in one sequence of symbols 1, 2, …"""

    def __init__(self, seq: np.ndarray):
        seq = np.concatenate((seq.astype(np.int64), [0]))
        self.n = len(seq)
        self.n_symbols = int(seq.max()) + 1
        order = suffix_array(seq)
        self.wavelet = WaveletMatrix(seq[order - 1], self.n_symbols)
        counts = np.bincount(seq, minlength=self.n_symbols)
        self.less = np.concatenate(([0], np.cumsum(counts)))[:-1]
        marked = order % SAMPLE_EVERY == 0
        self.marks = RankBits(marked.astype(np.uint8))
        self.samples = order[marked]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges ``[low, high)`` of the patterns, by backward search, all at once.

        Row ``p`` of ``patterns`` has its symbols right-aligned; symbols must be known.
        """
        width = patterns.shape[1]
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        for step in range(width):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, width - 1 - step]
            low[live] = self.less[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.less[symbol] + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of the suffixes in the rows."""
        out = np.zeros(len(rows), dtype=np.int64)
        left, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(left):
            done = self.marks.get(at).astype(bool)
            out[left[done]] = self.samples[self.marks.ones(at[done])] + steps
            left, at = left[~done], at[~done]
            if len(left):
                symbol, before = self.wavelet.access(at)
                at = self.less[symbol] + before
            steps += 1
        return out
