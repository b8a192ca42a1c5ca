"""Word and shingle hashes of a block of texts, vectorised with numpy.

Words are the runs of `[^\\x20\\x09-\\x0D]+`; those separators are single bytes
in UTF-8, so words are found on the bytes.  A word's hash is the polynomial of
its bytes modulo 2^64 (a difference of prefix sums, shifted to exponent 0 with
the inverse of the odd base), then mixed.  Runs of words are hashed the same
way over word hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


class ProcessCache(dict):
    """Kept by a process; what travels to tasks is empty."""

    def __reduce__(self):
        return ProcessCache, ()


_POWERS = ProcessCache()


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, grown by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, np.uint64) if have is None else have
        while len(have) < n:
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
        if n <= 1 << 23:  # one very long text must not stay in memory
            _POWERS[base] = have
    return have[:n]


def run_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each pair."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), out=total[1:])
    raw = (total[end] - total[start]) * _powers(_INVERSE, len(values) + 1)[start]
    return mix(raw ^ ((end - start).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)))


class Words:
    """Words of a column of texts: `hash`, and per text the range first[i]:first[i + 1]."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_string()).fill_null("")
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None and len(off) else np.zeros(0, np.uint8)
        off = off - off[0]
        if lower:
            data = _LOWER[data]
        inside = ~_SPACE[data]
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edge = off[1:-1]
        edge = edge[(edge > 0) & (edge < len(data))]
        start[edge] |= inside[edge]
        end[edge - 1] |= inside[edge - 1]
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, off)
        self.offsets = off
        self.hash = run_hashes(_BYTE[data], self.start, self.end)
        self.n = np.diff(self.first)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every run of k words, and bounds: text i has out[bounds[i]:bounds[i + 1]].
        A text of 1 to k - 1 words has its whole word sequence as its only shingle."""
        n = np.where(self.n >= k, self.n - k + 1, np.minimum(self.n, 1))
        bounds = np.concatenate([[0], np.cumsum(n)])
        own = np.repeat(np.arange(len(n)), n)
        at = np.arange(bounds[-1]) - bounds[own] + self.first[own]
        return run_hashes(self.hash, at, np.minimum(at + k, self.first[own + 1])), bounds
