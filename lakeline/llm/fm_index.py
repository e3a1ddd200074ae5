"""Full-text index of a sequence of small whole numbers, and searches of many phrases at once."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions in suffix order. The last symbol must be the smallest and occur once.

    Prefix doubling; rounds after the first sort only suffixes that still share their prefix,
    so long repeats cost rounds over the repeats, not over the text.
    """
    n = len(text)
    order = np.argsort(text, kind="stable").astype(np.int64)
    first = text[order]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)

    def regroup(todo: np.ndarray, positions: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """Rank each by the first slot of its group; the slots of groups of two and more."""
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, len(todo)))
        rank[positions] = np.repeat(todo[starts], sizes)
        return todo[np.repeat(sizes, sizes) > 1]

    todo = regroup(slots, order, np.append(True, first[1:] != first[:-1]))
    step = 1
    while len(todo):
        positions = order[todo]
        key = rank[positions] * n + rank[positions + step]
        by = np.argsort(key, kind="stable")
        positions, key = positions[by], key[by]
        order[todo] = positions
        todo = regroup(todo, positions, np.append(True, key[1:] != key[:-1]))
        step *= 2
    return order


class BitRank:
    """Bits in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words), np.int64)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Rank and access of the symbols of a sequence, one bit of the symbol per level."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.shifts = list(range(max(1, int(size - 1).bit_length())))[::-1]
        self.levels: list[tuple[BitRank, int]] = []
        for shift in self.shifts:
            bits = (symbols >> shift) & 1 == 1
            self.levels.append((BitRank(bits), int(len(bits) - bits.sum())))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        every = np.arange(size)
        self.begin = self._descend(every, np.zeros(size, np.int64))

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, (bits, zeros) in zip(self.shifts, self.levels):
            ones = bits.ones(at)
            at = np.where((symbols >> shift) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbols, at) - self.begin[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before."""
        symbols = np.zeros(len(at), np.int64)
        for shift, (bits, zeros) in zip(self.shifts, self.levels):
            one, ones = bits.get(at), bits.ones(at)
            symbols |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
        return symbols, at - self.begin[symbols]


class FmIndex:
    """Burrows-Wheeler transform of ``text`` (symbols from 1 to ``size - 1``) with an end mark."""

    def __init__(self, text: np.ndarray, size: int, sample: int = 16):
        text = np.append(text, 0).astype(np.int64)
        order = suffix_array(text)
        self.n, self.sample = len(text), sample
        self.wavelet = WaveletMatrix(text[order - 1], size)
        self.smaller = np.zeros(size + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=size), out=self.smaller[1:])
        kept = order % sample == 0
        self.sampled, self.positions = BitRank(kept), order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows from, to of the suffixes that begin with each phrase (rows of ``phrases``)."""
        return self.search_in(phrases.ravel(), np.arange(len(phrases)) * phrases.shape[1], lengths)

    def search_in(self, words: np.ndarray, starts: np.ndarray,
                  lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for phrases that are slices of one sequence."""
        low = np.zeros(len(starts), np.int64)
        high = np.full(len(starts), self.n, np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            symbols = words[starts[live] + lengths[live] - back]
            low[live] = self.smaller[symbols] + self.wavelet.rank(symbols, low[live])
            high[live] = self.smaller[symbols] + self.wavelet.rank(symbols, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of these rows: step back until a sampled suffix is met."""
        out = np.full(len(rows), -1, np.int64)
        left, rows = np.arange(len(rows)), rows.copy()
        for steps in range(self.sample):
            hit = self.sampled.get(rows)
            out[left[hit]] = self.positions[self.sampled.ones(rows[hit])] + steps
            left, rows = left[~hit], rows[~hit]
            if not len(left):
                break
            symbols, before = self.wavelet.access(rows)
            rows = self.smaller[symbols] + before
        return out
