"""Vectorised words, hashes and n-grams over the UTF-8 bytes of many texts at once."""

from __future__ import annotations

import numpy as np

from presscheck.llm.worker import kept

# Odd, so that it has an inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def lower_table() -> np.ndarray:
    """Byte to byte, with A-Z lower-cased."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def not_space() -> np.ndarray:
    """True for the bytes of words that white space (space, tab to carriage return) ends."""
    t = np.ones(256, bool)
    t[9:14] = False
    t[32] = False
    return t


def alphanumeric() -> np.ndarray:
    """True for digits, ASCII letters and all bytes of other characters."""
    t = np.zeros(256, bool)
    t[48:58] = t[97:123] = t[65:91] = True
    t[128:] = True
    return t


class Words:
    """Words of the texts in ``data``, none across two texts.

    ``start`` and ``end`` are byte places, ``doc`` the text's number, ``first`` the
    number of each text's first word (one entry more than texts), ``bounds`` the
    byte places of the texts.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray):
        self.data, self.bounds = data, bounds
        # A blank byte before each text keeps words apart.
        inside = np.zeros(len(data) + 1, np.int8)
        inside[:-1] = is_word[data]
        begins = inside[:-1].astype(bool)
        begins[1:] &= inside[:-2] == 0
        edges = bounds[1:-1]
        edges = edges[edges < len(data)]
        begins[edges] = inside[edges] == 1
        ends = inside[:-1].astype(bool) & (inside[1:] == 0)
        cut = edges[edges > 0] - 1
        ends[cut] |= inside[cut] == 1
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, bounds)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(bounds) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return Spans(self.data, seed).hashes(self.start, self.end)

    def text(self, i: int, j: int | None = None) -> bytes:
        """Word ``i``, or the words from ``i`` to before ``j`` with single blanks between."""
        if j is None:
            return self.data[self.start[i] : self.end[i]].tobytes()
        return b" ".join(self.data[self.start[x] : self.end[x]].tobytes() for x in range(i, j))


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def powers(base: int, count: int) -> np.ndarray:
    """The first powers of ``base`` modulo 2^64, kept from call to call."""
    known = kept("powers", dict)
    out = known.get(base, np.ones(1, np.uint64))
    while len(out) < count:
        step = np.uint64(pow(base, len(out), 1 << 64))
        out = np.concatenate([out, out * step])
    if len(out) <= 1 << 22:  # a single very long text makes its own
        known[base] = out
    return out[:count]


class Spans:
    """Hashes of byte spans from sums over prefixes: equal spans have equal hashes, wherever they lie."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        """``data`` holds bytes, or code points as larger numbers."""
        base = (_BASE + 2 * seed * 0x5851F42D4C957F2D) & (2**64 - 1)
        if data.dtype == np.uint8:
            values = mix(np.arange(256, dtype=np.uint64), seed + 1)[data]
        else:
            values = mix(data.astype(np.uint64), seed + 1)
        # Powers rise along the data; the inverse power brings a span's sum to its start.
        self.seed, self.back = np.uint64(seed), powers(_inverse(base), len(data))
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values * powers(base, len(data)), out=self.total[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not len(start):
            return np.zeros(0, np.uint64)
        value = (self.total[end] - self.total[start]) * self.back[start]
        return mix(value ^ (self.seed + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` consecutive entries; entry i covers i to i + n - 1."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = mix(hashes[:count], 3)
    for k in range(1, n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count], 3)
    return out


def whole_ngrams(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Starts of the n-grams that lie within one text."""
    ok = np.ones(max(total - n + 1, 0), bool)
    for back in range(1, n):
        at = first[1:-1] - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return np.flatnonzero(ok)
