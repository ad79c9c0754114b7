"""FM-index of a sequence of small integers, on numpy: batched search and location."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling.  The last symbol must be the only zero."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        beyond = np.zeros(n, np.int64)
        if step < n:
            beyond[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + beyond
        order = np.argsort(key)
        ordered = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Rank and access over a sequence, one bit vector with counts per bit of a symbol."""

    def __init__(self, sequence: np.ndarray, bits: int) -> None:
        self.bits = bits
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(bits - 1, -1, -1):
            bit = (sequence >> level & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            sequence = np.concatenate((sequence[~bit], sequence[bit]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before position ``end``."""
        start = np.zeros_like(end)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.bits - 1 - level) & 1).astype(bool)
            a, b = ones[start], ones[end]
            start = np.where(bit, zeros + a, start - a)
            end = np.where(bit, zeros + b, end - b)
        return end - start

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at positions, and how often each occurs before its position."""
        symbol = np.zeros_like(at)
        start = np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros):
            a, b = ones[start], ones[at]
            bit = ones[at + 1] > b
            symbol = symbol << 1 | bit
            start = np.where(bit, zeros + a, start - a)
            at = np.where(bit, zeros + b, at - b)
        return symbol, at - start


class FmIndex:
    """Index of ``text``, whose symbols are 1 and above."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 16) -> None:
        text = np.append(text, 0).astype(np.int64)
        order = suffix_array(text)
        self.tree = WaveletMatrix(text[order - 1], max(1, int(symbols).bit_length()))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 1))))
        sampled = order % sample == 0
        self._sampled = sampled
        self._number = np.cumsum(sampled) - 1
        self._samples = order[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``lo .. hi`` of the suffixes that start with each pattern (one per row)."""
        last = patterns[:, -1]
        lo, hi = self.before[last], self.before[last + 1]
        live = np.flatnonzero(lo < hi)
        for column in range(patterns.shape[1] - 2, -1, -1):
            if not len(live):
                break
            symbol = patterns[live, column]
            base = self.before[symbol]
            lo[live] = base + self.tree.rank(symbol, lo[live])
            hi[live] = base + self.tree.rank(symbol, hi[live])
            live = live[lo[live] < hi[live]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back to the nearest sampled one."""
        rows = rows.copy()
        steps = np.zeros_like(rows)
        open_rows = np.flatnonzero(~self._sampled[rows])
        while len(open_rows):
            symbol, rank = self.tree.access(rows[open_rows])
            rows[open_rows] = self.before[symbol] + rank
            steps[open_rows] += 1
            open_rows = open_rows[~self._sampled[rows[open_rows]]]
        return self._samples[self._number[rows]] + steps
