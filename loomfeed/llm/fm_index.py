"""FM-index over integer sequences: wavelet-tree ranks and sampled suffix positions, in numpy."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; the end sorts first."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[:-step] = rank[step:] if step < n else 0
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate(([0], (ordered[1:] != ordered[:-1]).astype(np.int64))).cumsum() + 1
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        if fresh[-1] == n:
            return order
        step *= 2


class WaveletTree:
    """Ranks of symbols in a sequence, level by level from the highest bit."""

    def __init__(self, values: np.ndarray, levels: int):
        self.levels = levels
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        now = values.astype(np.int64)
        for level in range(levels - 1, -1, -1):
            bit = (now >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int64))
            self.zeros.append(int(len(now) - bit.sum()))
            now = np.concatenate((now[bit == 0], now[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``at``, for arrays of both."""
        start, stop = np.zeros_like(at), at
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            bit = ((symbol >> level) & 1).astype(bool)
            a, b = self.ones[i][start], self.ones[i][stop]
            start = np.where(bit, self.zeros[i] + a, start - a)
            stop = np.where(bit, self.zeros[i] + b, stop - b)
        return stop - start

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at these places."""
        place, out = at.copy(), np.zeros_like(at)
        for i in range(self.levels):
            ones = self.ones[i]
            bit = ones[place + 1] - ones[place]
            out = out * 2 + bit
            place = np.where(bit == 1, self.zeros[i] + ones[place], place - ones[place])
        return out


class FMIndex:
    """Backward search over one shard. Symbols are 1 and up; 0 separates sequences.

    Inside, all symbols are one higher and a single 0 ends the text.
    """

    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE):
        text = np.concatenate((np.asarray(text) + 1, [0])).astype(np.int64)
        order = suffix_array(text)
        self.n, self.sample = len(text), sample
        levels = int(symbols + 1).bit_length()
        self.tree = WaveletTree(text[order - 1], levels)
        counts = np.bincount(text, minlength=symbols + 2)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        marked = order % sample == 0
        self.marks = np.concatenate(([0], np.cumsum(marked)))
        self.places = order[marked]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix range of each pattern (rows, filled from the left, of ``lengths``)."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        live = np.arange(len(patterns))
        for back in range(patterns.shape[1]):
            live = live[(lengths[live] > back) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - 1 - back] + 1
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to the next sampled one."""
        out, steps, row = np.full(len(rows), -1, dtype=np.int64), 0, rows.copy()
        todo = np.arange(len(rows))
        while len(todo):
            marked = self.marks[row + 1] > self.marks[row]
            out[todo[marked]] = self.places[self.marks[row[marked]]] + steps
            todo, row = todo[~marked], row[~marked]
            symbol = self.tree.access(row)
            row = self.before[symbol] + self.tree.rank(symbol, row)
            steps += 1
        return out
