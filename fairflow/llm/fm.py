"""An FM-index over a sequence of word numbers, in numpy.

Symbol 0 separates stretches of text; a match never crosses it.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


class WaveletRanks:
    """Ranks of symbols in a sequence: one bit vector per bit of the symbols, highest first, each
    stably partitioned by its bit for the next (a wavelet tree laid out level by level)."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels = max(1, (alphabet - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        current, n = symbols, len(symbols)
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level & 1).astype(bool)
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            raw = np.packbits(bit, bitorder="little")
            packed[:len(raw)] = raw
            words = packed.view("<u8")
            counts = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=counts[1:])
            self.words.append(words)
            self.counts.append(counts)
            self.zeros.append(n - int(counts[-1]))
            current = np.concatenate((current[~bit], current[bit]))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end."""
        begin, end = np.zeros(len(ends), np.int64), ends.astype(np.int64)
        for k in range(self.levels):
            words, counts = self.words[k], self.counts[k]
            one = (symbols >> (self.levels - 1 - k) & 1).astype(bool)
            moved = []
            for at in (begin, end):
                rest = words[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
                ones = counts[at >> 6] + np.bitwise_count(rest)
                moved.append(np.where(one, self.zeros[k] + ones, at - ones))
            begin, end = moved
        return end - begin


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling; every separator is a symbol of its own, in order of position."""
    n = len(symbols)
    separators = symbols == 0
    rank = np.where(separators, np.cumsum(separators) - 1, symbols + int(separators.sum())).astype(np.uint64)
    step = 1
    while True:
        after = np.zeros(n, np.uint64)
        after[:n - step] = rank[step:] + np.uint64(1)
        key = rank * np.uint64(n + int(symbols.max()) + 2) + after
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(n, np.uint64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class FMIndex:
    """Backward search over wavelet ranks, positions from sampled suffix positions."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        order = suffix_array(symbols)
        self.size = len(symbols)
        self.last = symbols[order - 1]  # the suffix at 0 takes the final separator
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=alphabet))))
        self.ranks = WaveletRanks(self.last, alphabet)
        # A walk back from a match ends at a sampled position or at the beginning of its stretch.
        self.sampled = (order % SAMPLE == 0) | (self.last == 0)
        self.samples = order[self.sampled]
        self.sample_of = np.cumsum(self.sampled) - 1

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the index that begin with each phrase (a row of symbols): the phrases found, and
        the first and end row of each."""
        alive = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size)
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, k]
            low = self.before[symbol] + self.ranks.rank(symbol, low)
            high = self.before[symbol] + self.ranks.rank(symbol, high)
            found = low < high
            alive, low, high = alive[found], low[found], high[found]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of index rows."""
        out = np.zeros(len(rows), np.int64)
        open_, row, steps = np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            here = self.sampled[row]
            out[open_[here]] = self.samples[self.sample_of[row[here]]] + steps
            open_, row = open_[~here], row[~here]
            symbol = self.last[row]
            row = self.before[symbol] + self.ranks.rank(symbol, row)
            steps += 1
        return out
