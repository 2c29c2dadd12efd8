"""Words ``[^\\x20\\x09-\\x0D]+`` of whole texts as numpy arrays, for use inside tasks.

Texts are handled as UTF-8 bytes: the separators are ASCII, so cutting bytes
equals cutting characters. Work goes in pieces of a few MB; only per-word
arrays grow with a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
PIECE = 1 << 21  # bytes in which texts are taken, times 1 to 4
SLICE = 1 << 20  # the same where a task would hold much for each byte: workers are reused and keep their peak
HASHED = 1 << 18  # bytes whose hashes are worked out at once

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64)  # a random value for each byte
_BASE = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_pow: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i up to n (kept up to ``HASHED``)."""
    got = _pow.get(which)
    if got is None or len(got[0]) <= n:
        size = max(n + 1, HASHED + 1)
        base = _BASE[which]
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.empty(size, dtype=np.uint64)
            out[0] = 1
            done, step = 1, b
            while done < size:  # doubling: out[done:2*done] = out[:done] * b**done
                m = min(done, size - done)
                out[done:done + m] = out[:m] * np.uint64(step)
                step = step * step % (1 << 64)
                done += m
            both.append(out)
        got = (both[0], both[1])
        if size == HASHED + 1:
            _pow[which] = got
    return got


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string column as one byte array, and n+1 offsets; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``buf``; texts begin at ``offs`` and no word crosses one."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~SPACE[buf]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    edges = offs[:-1][offs[:-1] < len(buf)]
    begins[edges] = word[edges]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    edges = offs[1:][offs[1:] > 0] - 1
    ends[edges] = word[edges]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over random byte values, from prefix sums."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + HASHED, "right")))
        a, b = int(starts[at]), int(ends[to - 1])
        up, down = powers(which, b - a)
        prefix = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum(_BYTE[which][buf[a:b]] * up[:b - a], out=prefix[1:])
        s, e = starts[at:to] - a, ends[at:to] - a
        out[at:to] = mix((prefix[e] - prefix[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


def pieces(column: pa.Array, size: int = 4 * PIECE):
    """(first row, end row) ranges of a column whose texts sum to about ``size`` bytes."""
    import pyarrow.compute as pc
    n = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, total = 0, np.concatenate([[0], np.cumsum(n)])
    while at < len(n):
        to = max(at + 1, int(np.searchsorted(total, total[at] + size, "right")) - 1)
        yield at, to
        at = to


def windows(ids: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hash of every ``width`` consecutive word hashes (wrapping sums of weighted ids)."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    weights = np.random.default_rng(77 + which).integers(1, 1 << 63, width, dtype=np.uint64) | np.uint64(1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        out += ids[i:i + n] * weights[i]
    return mix(out)
