"""A compressed full-text index (FM-index) of an integer sequence, in numpy.

The Burrows-Wheeler transform is kept in a wavelet tree stored level by level; searches run
for all phrases at once.
"""

from __future__ import annotations

import numpy as np

from sluice.llm.suffix import suffix_array


class FMIndex:
    """Index of ``symbols`` (integers from 1 to ``largest``); every ``sample``-th position is stored."""

    def __init__(self, symbols: np.ndarray, largest: int, sample: int = 8):
        text = np.append(symbols.astype(np.int64), 0)  # 0 ends the text and is its least symbol
        order, _ = suffix_array(text)
        self.size = len(text)
        self.transform = text[order - 1]
        self.before = np.zeros(largest + 2, dtype=np.int64)
        np.cumsum(np.bincount(text, minlength=largest + 1), out=self.before[1:])
        self.levels = max(1, int(largest).bit_length())
        self.ones: list[np.ndarray] = []  # at each level, ones among the first i bits
        self.zeros: list[int] = []  # and how many zeros the level has
        values = self.transform
        for level in reversed(range(self.levels)):
            bits = (values >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bits)]))
            self.zeros.append(int(len(bits) - bits.sum()))
            values = np.concatenate([values[bits == 0], values[bits == 1]])
        self.sampled = order % sample == 0
        self.sample_number = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Occurrences of each ``symbol`` among the first ``upto`` symbols of the transform."""
        start, end = np.zeros_like(upto), upto
        for depth, level in enumerate(reversed(range(self.levels))):
            ones, zeros = self.ones[depth], self.zeros[depth]
            one = ((symbol >> level) & 1) == 1
            start = np.where(one, zeros + ones[start], start - ones[start])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return end - start

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots [low, high) of the suffixes that begin with each row of ``phrases``, read from
        its last symbol to its first; phrases that ran empty are dropped from the work."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        alive = np.arange(len(phrases))
        for k in reversed(range(phrases.shape[1])):
            symbol = phrases[alive, k]
            low[alive] = self.before[symbol] + self.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, slots: np.ndarray) -> np.ndarray:
        """Position in the text of the suffix in each slot: steps back until a stored one."""
        found, steps = np.zeros(len(slots), dtype=np.int64), np.zeros(len(slots), dtype=np.int64)
        left, at = np.arange(len(slots)), slots.astype(np.int64)
        while len(left):
            here = self.sampled[at]
            found[left[here]] = self.samples[self.sample_number[at[here]]] + steps[left[here]]
            left, at = left[~here], at[~here]
            symbol = self.transform[at]
            at = self.before[symbol] + self.rank(symbol, at)
            steps[left] += 1
        return found
