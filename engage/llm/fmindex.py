"""A compressed full-text index of word sequences: suffix order, Burrows-Wheeler transform in a wavelet matrix, and backward
search for many patterns at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with constant-time rank: packed words and the ones before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words) + 1, dtype=np.int32)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Symbols 0 .. sigma - 1, one bit vector for each binary digit, from the highest."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.digits = max(1, int(sigma - 1).bit_length())
        self.levels: list[tuple[int, Bits, int]] = []
        for d in range(self.digits - 1, -1, -1):
            bit = (symbols >> d) & 1
            ones = bit.astype(bool)
            self.levels.append((d, Bits(bit), len(symbols) - int(ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        every = np.arange(sigma)
        self.base = self._down(every, np.zeros(sigma, dtype=np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for d, bits, zeros in self.levels:
            one = bits.rank(i)
            i = np.where((c >> d) & 1, zeros + one, i - one)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol ``c`` stands before place ``i``."""
        return self._down(c, i) - self.base[c]


def suffix_order(text: np.ndarray, longest: int) -> np.ndarray:
    """Suffixes in order, by doubling; no two agree on more than ``longest`` symbols."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank, k = rank.astype(np.int64), 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        k *= 2
        if k >= longest or rank[order[-1]] == n - 1:
            return order


class FMIndex:
    """Index of several sequences of symbols 1 .. sigma - 1, in the given order, each closed by an end mark.

    ``text`` holds all of them one after another; end marks are 0 and differ among themselves in the suffix order by place.
    """

    def __init__(self, text: np.ndarray, sigma: int, longest: int):
        self.text = text
        marks = text == 0
        distinct = text + int(marks.sum())
        distinct[marks] = np.arange(int(marks.sum()))
        self.order = suffix_order(distinct, longest + 1)
        self.matrix = WaveletMatrix(text[self.order - 1], sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])

    def earliest(self, starts: np.ndarray, length: int) -> np.ndarray:
        """For the run of ``length`` symbols at each place: the first place in the whole text where the same run starts."""
        return self.least(starts, length, np.arange(len(self.text)))

    def least(self, starts: np.ndarray, length: int, values: np.ndarray) -> np.ndarray:
        """The same, with the least of ``values`` (one for each place of the text) over the places where the run starts.

        Backward search of all runs together; a run whose interval has shrunk to one suffix occurs nowhere else and is done.
        """
        result = values[starts]
        rows = np.arange(len(starts))
        c = self.text[starts + length - 1]
        low, high = self.first[c], self.first[c + 1]
        for k in range(length - 2, -1, -1):
            going = high - low > 1
            rows, low, high = rows[going], low[going], high[going]
            if not len(rows):
                return result
            c = self.text[starts[rows] + k]
            low = self.first[c] + self.matrix.rank(c, low)
            high = self.first[c] + self.matrix.rank(c, high)
        several = high - low > 1
        rows, low, high = rows[several], low[several], high[several]
        if len(rows):
            result[rows] = self._least(low, high, values)
        return result

    def _least(self, low: np.ndarray, high: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Smallest value among the suffixes of each interval, by tables of minima over powers of two."""
        answer = np.empty(len(low), dtype=np.int64)
        table, span = values[self.order].astype(np.int32), 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in range(int(level.max()) + 1):
            own = np.flatnonzero(level == k)
            answer[own] = np.minimum(table[low[own]], table[high[own] - span])
            table = np.minimum(table[: len(table) - span], table[span:]) if len(table) > span else table
            span *= 2
        return answer
