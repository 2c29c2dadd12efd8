"""A compressed FM-index over word sequences, for one shard inside a task.

The suffixes are sorted by their first ``depth`` symbols, which is all that
patterns of at most that length need. The Burrows-Wheeler transform lies in a
wavelet matrix: one packed bit vector a level, with counts every 64 bits.
Backward steps take arrays of intervals, so many streams advance together.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """Rank over a packed bit vector."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.zeros((n // 64 + 1) * 8, dtype=np.uint8)
        packed[:(n + 7) // 8] = np.packbits(bits, bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])[:-1].astype(np.int32)
        self.zeros = n - int(bits.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Number of ones before each position."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class Wavelet:
    """Wavelet matrix: how often a symbol occurs before a position."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = []
        self.height = max(1, int(sigma - 1).bit_length())
        now = symbols
        for level in range(self.height - 1, -1, -1):
            bits = (now >> level) & 1 == 1
            self.levels.append(Bits(bits))
            now = np.concatenate([now[~bits], now[bits]])
        self.start = self._descend(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, bits in enumerate(self.levels):
            ones = bits.rank(at)
            at = np.where((symbol >> (self.height - 1 - i)) & 1 == 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._descend(symbol, at) - self.start[symbol]


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


class FMIndex:
    """Index of sequences of positive symbols, for patterns of up to ``depth`` symbols."""

    def __init__(self, sequences: np.ndarray, lengths: np.ndarray, depth: int):
        """``sequences`` holds all symbols in a row; each sequence is closed by symbol 0."""
        n = len(sequences) + len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(n, dtype=np.int64)
        inside = np.ones(n, dtype=bool)
        inside[ends] = False
        text[inside] = sequences
        self.text, self.depth, self.n = text, depth, n
        of = np.zeros(n, dtype=np.int64)
        of[ends[:-1] + 1] = 1
        self.sequence = np.cumsum(of)  # of each position of the text

        def double(a, b, shift):  # ranks by len(a) + len(b) symbols
            after = np.zeros(n, dtype=np.int64)
            after[:n - shift] = b[shift:] + 1
            return _ranks(a * (n + 2) + after)

        powers, reach = {1: _ranks(text)}, 1
        while reach * 2 <= depth - 1:
            powers[reach * 2] = double(powers[reach], powers[reach], reach)
            reach *= 2
        less, have = powers[reach], reach  # ranks by depth - 1 symbols
        for step in sorted(powers, reverse=True):
            if have + step <= depth - 1:
                less, have = double(less, powers[step], have), have + step
        full = double(less, powers[1], depth - 1)
        self.order = np.argsort(full, kind="stable")
        # rows that agree in depth - 1 symbols: where dropping the last symbol of a full pattern widens to
        shorter = less[self.order]
        new = np.flatnonzero(np.concatenate([[True], shorter[1:] != shorter[:-1]]))
        group = np.cumsum(np.concatenate([[False], shorter[1:] != shorter[:-1]]))
        self.wide = new[group], np.append(new[1:], n)[group]
        self.sigma = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))])[:-1]
        self.wavelet = Wavelet(text[self.order - 1], self.sigma)  # position -1 is the last separator

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put in front."""
        both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        k = len(symbol)
        return self.first[symbol] + both[:k], self.first[symbol] + both[k:]

    def drop_last(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of full patterns without their last symbol."""
        return self.wide[0][lo], self.wide[1][lo]


def window_intervals(index: FMIndex, sequences: np.ndarray, lengths: np.ndarray):
    """Stream sequences through the index; (sequence, place, lo, hi) of every full-length match.

    From right to left each stream holds the interval of the longest match
    that begins at its place, cut at ``depth`` symbols; a stream whose match is
    not found starts again with the next symbol.
    """
    if not len(lengths):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    ends = np.cumsum(lengths)
    m = len(lengths)
    lo, hi, have = np.zeros(m, np.int64), np.full(m, index.n, np.int64), np.zeros(m, np.int64)
    out = []
    for back in range(1, int(lengths.max()) + 1):
        live = np.flatnonzero(lengths >= back)
        at = ends[live] - back
        symbol = sequences[at]
        a, b, h = lo[live], hi[live], have[live]
        full = h == index.depth
        if full.any():
            a[full], b[full] = index.drop_last(a[full])
            h[full] -= 1
        a, b = index.step(symbol, a, b)
        lost = a >= b
        if lost.any():  # the symbol alone
            zero = np.zeros(int(lost.sum()), dtype=np.int64)
            a[lost], b[lost] = index.step(symbol[lost], zero, zero + index.n)
            h[lost] = np.where(a[lost] < b[lost], 0, -1)
            a[lost], b[lost] = np.where(h[lost] < 0, 0, a[lost]), np.where(h[lost] < 0, index.n, b[lost])
        lo[live], hi[live], have[live] = a, b, h + 1
        found = h + 1 == index.depth
        if found.any():
            out.append((live[found], lengths[live[found]] - back, a[found], b[found]))
    if not out:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))
