"""Open addressing for whole arrays: 64-bit hashes to small integers, probed with numpy inside tasks."""

from __future__ import annotations

import numpy as np


class Slots:
    """A hash table of uint64 keys (0 is stored as 1) with int32 values; it doubles before it is half full."""

    def __init__(self, bits: int = 12):
        self._make(bits)

    def _make(self, bits: int) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.values = np.zeros(1 << bits, dtype=np.int32)
        self.size = 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """The value of each hash, -1 where it is not stored."""
        h = np.maximum(h, np.uint64(1))
        at = (h & self.mask).astype(np.int64)
        there = self.keys[at]
        out = np.where(there == h, self.values[at], np.int32(-1))
        left = np.flatnonzero((there != h) & (there != 0))
        at = at[left]
        while len(left):
            at = (at + 1) & int(self.mask)
            there = self.keys[at]
            hit = there == h[left]
            out[left[hit]] = self.values[at[hit]]
            on = ~hit & (there != 0)
            left, at = left[on], at[on]
        return out

    def add(self, h: np.ndarray, values: np.ndarray) -> None:
        """Store distinct hashes that are not stored yet."""
        h = np.maximum(h, np.uint64(1))
        while 2 * (self.size + len(h)) > len(self.keys):
            used = np.flatnonzero(self.keys)
            keys, old = self.keys[used], self.values[used]
            self._make(int(self.mask).bit_length() + 1)
            self._place(keys, old)
        self._place(h, values)

    def _place(self, h: np.ndarray, values: np.ndarray) -> None:
        self.size += len(h)
        at = (h & self.mask).astype(np.int64)
        while len(h):
            free = self.keys[at] == 0
            self.keys[at[free]] = h[free]  # of several at one place the last stays
            placed = free & (self.keys[at] == h)
            self.values[at[placed]] = values[placed]
            h, values, at = h[~placed], values[~placed], (at[~placed] + 1) & int(self.mask)
