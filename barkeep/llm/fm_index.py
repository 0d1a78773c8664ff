"""An FM-index over a sequence of word numbers, with numpy inside one task.

Symbols are 1 and up; 0 ends a run and is never searched for. Suffixes are sorted by
prefix doubling, where every end of a run counts as a symbol of its own. The transformed
sequence is kept as a wavelet matrix: one row of bits per level with counts of zeros.
"""

import numpy as np


def suffix_order(sequence):
    """Starts of the suffixes in sorted order."""
    n = len(sequence)
    ends = np.flatnonzero(sequence == 0)
    rank = sequence.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    _, rank = np.unique(rank, return_inverse=True)
    offset = 1
    while True:
        after = np.full(n, -1, np.int64)
        after[: n - offset] = rank[offset:]
        key = rank * (n + 1) + after + 1
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, bool)
        fresh[:1] = True
        np.not_equal(key[order][1:], key[order][:-1], out=fresh[1:])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        if fresh.all():
            return order
        offset *= 2


class FMIndex:
    """Backward search for many patterns at once, and their places."""

    def __init__(self, sequence, sample=8):
        """``sequence`` must end with 0."""
        self.n = len(sequence)
        order = suffix_order(sequence)
        before = sequence[order - 1]
        self.levels = max(1, int(sequence.max()).bit_length())
        self.below = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=(1 << self.levels) + 1))])
        self.zeros, bits = [], before
        for level in range(self.levels - 1, -1, -1):
            bit = (bits >> level) & 1
            self.zeros.append(np.concatenate([[0], np.cumsum(1 - bit)]))
            bits = np.concatenate([bits[bit == 0], bits[bit == 1]])
        # A walk back stops at a sampled place; starts of runs are sampled, so it never leaves its run.
        self.sampled = (order % sample == 0) | (before == 0)
        self.at = np.where(self.sampled, order, -1)

    def rank(self, symbol, i):
        """Occurrences of each symbol among the first i entries of the transformed sequence."""
        lo = np.zeros_like(i)
        for depth, level in enumerate(range(self.levels - 1, -1, -1)):
            zeros = self.zeros[depth]
            one = ((symbol >> level) & 1).astype(bool)
            lo = np.where(one, zeros[-1] + lo - zeros[lo], zeros[lo])
            i = np.where(one, zeros[-1] + i - zeros[i], zeros[i])
        return i - lo

    def symbol(self, i):
        """The entries of the transformed sequence at i."""
        found = np.zeros_like(i)
        for depth in range(self.levels):
            zeros = self.zeros[depth]
            one = zeros[i + 1] == zeros[i]
            found = found * 2 + one
            i = np.where(one, zeros[-1] + i - zeros[i], zeros[i])
        return found

    def find(self, patterns, lengths):
        """Suffix ranges of patterns given as rows, aligned to the left and padded with 0."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.n, np.int64)
        alive = np.flatnonzero((patterns.max(axis=1, initial=0) < 1 << self.levels) & (lengths > 0))
        hi[np.setdiff1d(np.arange(len(patterns)), alive)] = 0
        for step in range(int(lengths.max(initial=0))):
            alive = alive[lo[alive] < hi[alive]]
            now = alive[lengths[alive] > step]
            symbol = patterns[now, lengths[now] - 1 - step]
            lo[now] = self.below[symbol] + self.rank(symbol, lo[now])
            hi[now] = self.below[symbol] + self.rank(symbol, hi[now])
        return lo, np.maximum(lo, hi)

    def locate(self, rows):
        """Places in the sequence of the suffixes in the given rows."""
        place = np.empty(len(rows), np.int64)
        todo, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(todo):
            here = self.sampled[rows]
            place[todo[here]] = self.at[rows[here]] + steps
            todo, rows = todo[~here], rows[~here]
            symbol = self.symbol(rows)
            rows = self.below[symbol] + self.rank(symbol, rows)
            steps += 1
        return place
