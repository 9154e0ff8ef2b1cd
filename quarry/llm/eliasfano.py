"""Elias-Fano sequences and a two-level n-gram trie over them, in numpy.

A monotone sequence of n values below u keeps the low log2(u/n) bits of each
value packed and the high parts as a bit vector of unary gaps; access and
successor search need only counts of set bits. All parts are flat arrays that
can be written to a file and memory-mapped.
"""

from __future__ import annotations

import numpy as np

_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
# Position of the k-th set bit (from the lowest) of each byte.
_SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _k, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _SELECT[_b, _k] = _p
_U = np.uint64


class Bits:
    """A bit vector with select over its ones or zeros."""

    def __init__(self, data: np.ndarray, before: np.ndarray, flip: int = 0):
        self.data, self.before, self.flip = data, before, flip

    @staticmethod
    def counts(data: np.ndarray, flip: int = 0) -> np.ndarray:
        """Set bits before each byte."""
        return np.concatenate(([0], np.cumsum(_ONES[data ^ np.uint8(flip)], dtype=np.int64)))

    def select(self, k: np.ndarray) -> np.ndarray:
        """Positions of the bits number k (from 0), which must exist."""
        byte = np.searchsorted(self.before, k, "right") - 1
        return byte * 8 + _SELECT[self.data[byte] ^ np.uint8(self.flip), k - self.before[byte]]


class EliasFano:
    """A non-decreasing sequence of integers from 0 to ``universe - 1``."""

    NAMES = ("low", "high")

    def __init__(self, n: int, universe: int, low: np.ndarray, high: np.ndarray):
        self.n, self.universe, self.low, self.high = n, universe, low, high
        self.width = self._width(n, universe)
        self.ones = Bits(high, Bits.counts(high))
        self.zeros = Bits(high, Bits.counts(high, 255), 255)

    @staticmethod
    def _width(n: int, universe: int) -> int:
        return max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        values, n = values.astype(_U), len(values)
        width = cls._width(n, universe)
        low = np.zeros(n * width // 64 + 2, _U)
        if width:
            part = values & _U((1 << width) - 1)
            at = np.arange(n, dtype=np.int64) * width
            word, shift = at >> 6, (at & 63).astype(_U)
            np.bitwise_or.at(low, word, part << shift)
            over = (at & 63) + width > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (_U(64) - shift[over]))
        places = (values >> _U(width)).astype(np.int64) + np.arange(n)
        size = n + (universe >> width) + 1
        bits = np.zeros((size + 8) // 8 * 8, np.uint8)
        bits[places] = 1
        return cls(n, universe, low, np.packbits(bits, bitorder="little"))

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at positions i."""
        high = (self.ones.select(i) - i).astype(_U)
        if not self.width:
            return high
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(_U)
        part = self.low[word] >> shift
        over = (at & 63) + self.width > 64
        part[over] |= self.low[word[over] + 1] << (_U(64) - shift[over])
        return high << _U(self.width) | part & _U((1 << self.width) - 1)

    def successor(self, x: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """First position from begin on, before end, whose value is at least
        x, else end. The high part of x leaves one bucket to search."""
        end = self.n if end is None else end
        x = np.asarray(x).astype(_U)
        inside = x < _U(self.universe)
        high = np.where(inside, x >> _U(self.width), _U(0)).astype(np.int64)
        lo = np.where(high > 0, self.zeros.select(np.maximum(high - 1, 0)) - high + 1, 0)
        hi = self.zeros.select(high) - high
        lo, hi = np.clip(lo, begin, end), np.clip(hi, begin, end)
        lo = np.where(inside, lo, end)
        hi = np.where(inside, hi, end)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.access(mid) < x[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        return lo

    def find(self, x: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """Position of x, or -1 where it does not occur."""
        x = np.asarray(x)
        if not self.n or not len(x):
            return np.full(len(x), -1)
        at = self.successor(x, begin, end)
        last = self.n if end is None else end
        got = at < last
        hit = np.zeros(len(x), bool)
        hit[got] = self.access(at[got]) == x[got].astype(_U)
        return np.where(hit, at, -1)


class Trie:
    """Contexts, the words seen after each, and a quantised value per pair.

    The words of all contexts form a vocabulary; a child of context i is
    stored as i * vocabulary size + word number, which makes the level one
    monotone sequence, and is sought between the context's two pointers.
    """

    BITS = 40

    def __init__(self, vocabulary, contexts, pointers, children, codes, book):
        self.vocabulary, self.contexts, self.pointers, self.children = vocabulary, contexts, pointers, children
        self.codes, self.book = codes, book

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, value: np.ndarray) -> Trie:
        """From distinct pairs sorted by context and word, and their values."""
        full = 1 << cls.BITS
        words, number = np.unique(word, return_inverse=True)
        starts, first = np.unique(context, return_index=True)
        index = np.searchsorted(starts, context)
        low, high = (float(value.min()), float(value.max())) if len(value) else (0.0, 0.0)
        step = (high - low) / 255 or 1.0
        codes = np.rint((value - low) / step).astype(np.uint8)
        sizes = max(1, len(words))
        return cls(
            EliasFano.encode(words, full), EliasFano.encode(starts, full),
            EliasFano.encode(np.append(first, len(context)), len(context) + 1),
            EliasFano.encode(index.astype(_U) * _U(sizes) + number.astype(_U), max(1, len(starts)) * sizes),
            codes, low + step * np.arange(256))

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Values of pairs, NaN for pairs that the trie does not hold."""
        out = np.full(len(context), np.nan)
        if not self.children.n:
            return out
        asked, which = np.unique(context, return_inverse=True)  # each context and word is sought once
        place = self.contexts.find(asked)
        begin, end = (self.pointers.access(np.maximum(place, 0) + i).astype(np.int64) for i in (0, 1))
        words, spelt = np.unique(word, return_inverse=True)
        number = self.vocabulary.find(words)[spelt]
        known = np.flatnonzero((place[which] >= 0) & (number >= 0))
        at, number, which = place[which[known]], number[known], which[known]
        begin, end = begin[which], end[which]
        child = self.children.find(at.astype(_U) * _U(self.vocabulary.n) + number.astype(_U), begin, end)
        hit = child >= 0
        out[known[hit]] = self.book[self.codes[child[hit]]]
        return out

    def save(self, path: str) -> None:
        """One file: a table of array places, then the arrays."""
        parts = [x for s in self._sequences() for x in (np.array([s.n, s.universe], np.int64), s.low, s.high)] + [self.codes, self.book]
        sizes = np.array([x.nbytes for x in parts], np.int64)
        with open(path, "wb") as f:
            f.write(sizes.tobytes())
            for x in parts:
                f.write(x.tobytes())
                f.write(b"\0" * (-x.nbytes % 8))

    def _sequences(self):
        return self.vocabulary, self.contexts, self.pointers, self.children

    @classmethod
    def load(cls, path: str) -> Trie:
        """Open a saved trie memory-mapped."""
        data = np.memmap(path, np.uint8, "r")
        sizes = data[:14 * 8].view(np.int64)
        at, parts = 14 * 8, []
        for size, kind in zip(sizes.tolist(), [np.int64, _U, np.uint8] * 4 + [np.uint8, np.float64]):
            parts.append(data[at:at + size].view(kind))
            at += size + -size % 8
        levels = [EliasFano(int(parts[i][0]), int(parts[i][1]), parts[i + 1], parts[i + 2]) for i in range(0, 12, 3)]
        return cls(*levels, parts[12], parts[13])
