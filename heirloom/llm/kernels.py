"""Vectorised hashing of bytes, words and windows.

All hashes are polynomial prefix sums modulo 2**64 over a random byte table:
with ``G[i] = sum(T[c[j]] * B**j for j < i)`` the span ``[s, e)`` hashes to
``(G[e] - G[s]) * B**-s`` whatever its place, and a finalizer spreads the bits.
"""

from __future__ import annotations

import numpy as np

from heirloom.llm.common import batches_of

_M = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 20


def _splitmix(seed: int, n: int) -> np.ndarray:
    """``n`` reproducible random 64-bit numbers."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed & _M)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer of each number."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


TABLE = _splitmix(7, 256)
#: The same with A-Z read as a-z.
LOWER = TABLE.copy()
LOWER[65:91] = TABLE[97:123]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) <= n:
        size = max(n + 1, _PIECE + 4096)
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """``G`` of hashed values: one longer than the input."""
    pw, _ = powers(len(values))
    g = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * pw[: len(values)], out=g[1:])
    return g


def span_hashes(g: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, ip = powers(len(g))
    return mix((g[ends] - g[starts]) * ip[starts])


def window_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` values; empty if there are fewer."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = prefix_sums(values)
    _, ip = powers(n)
    return mix((g[k:] - g[:-k]) * ip[:n])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` numbers, by doubling."""
    if len(x) < w:
        return x[:0]
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    if have < w:
        x = np.minimum(x[: len(x) - (w - have)], x[w - have :])
    return x


def _cut_at_space(blob: bytes, at: int, limit: int) -> int:
    """An end of a piece from ``at`` on that cuts no word, near ``limit`` bytes."""
    end = at + limit
    if end >= len(blob):
        return len(blob)
    while end > at and not SPACE[blob[end]]:
        end -= 1
    if end > at:
        return end
    end = at + limit
    while end < len(blob) and not SPACE[blob[end]]:
        end += 1
    return end


def word_hashes(blobs: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of bytes that are no ASCII whitespace), and their number in each blob."""
    pieces, owner = [], []
    for i, b in enumerate(blobs):
        at = 0
        while len(b) - at > _PIECE:
            end = _cut_at_space(b, at, _PIECE)
            pieces.append(b[at:end])
            owner.append(i)
            at = end
        pieces.append(b[at:] if at else b)
        owner.append(i)
    table, hashes = LOWER if lower else TABLE, []
    counts = np.zeros(len(blobs), np.int64)
    owner_of = np.array(owner, np.int64)
    for lo, hi in batches_of(pieces, _PIECE):
        buf = np.frombuffer(b" ".join(pieces[lo:hi]) + b" ", np.uint8)
        word = ~SPACE[buf]
        edge = np.diff(word.view(np.int8), prepend=np.int8(0))
        starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        g = prefix_sums(table[buf])
        hashes.append(span_hashes(g, starts, ends) + (ends - starts).astype(np.uint64))
        offsets = np.cumsum([0] + [len(p) + 1 for p in pieces[lo:hi]])
        np.add.at(counts, owner_of[lo:hi], np.diff(np.searchsorted(starts, offsets)))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs ``starts[i] .. starts[i] + lengths[i]`` one after another."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    out = np.ones(ends[-1], np.int64)
    some = lengths > 0
    s, n = starts[some], lengths[some]
    at = np.concatenate(([0], np.cumsum(n)[:-1]))
    out[0] = s[0]
    out[at[1:]] = s[1:] - (s[:-1] + n[:-1] - 1)
    return np.cumsum(out)


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new group begins in rows sorted by ``keys``."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.nonzero(new)[0]


class HashIndex:
    """Places of 64-bit hashes in a sorted array, by a table over their high bits."""

    BITS = 18

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        top = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        self.slot = np.full(1 << self.BITS, -1, np.int32)
        self.slot[top[::-1]] = np.arange(len(top) - 1, -1, -1, dtype=np.int32)
        # A small table answers most misses from cache.
        self.any = self.slot >= 0
        runs = np.diff(np.append(group_starts(top), len(top)))
        self.longest = int(runs.max()) if len(runs) else 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        top = (h >> np.uint64(64 - self.BITS)).view(np.int64)
        live = np.nonzero(self.any[top])[0]
        at, want = self.slot[top[live]].astype(np.int64), h[live]
        out = np.full(len(h), -1, np.int32)
        for _ in range(self.longest):
            hit = self.hashes[at] == want
            out[live[hit]] = at[hit]
            rest = ~hit & (at + 1 < len(self.hashes))
            live, at, want = live[rest], at[rest] + 1, want[rest]
            if not len(live):
                break
        return out
