"""An FM-index over one shard's word ids: backward search and location for many patterns
at once, with ranks from a wavelet matrix of packed bits."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


class Bits:
    """A bit vector with constant-time ranks: packed words and their running counts."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.concatenate([bits, np.zeros(64 + -len(bits) % 64, bool)]), bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int64)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before position i."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) > 0


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes by prefix doubling.  Each 0 ends its run and differs from every
    other 0 (the earlier is the smaller), so no comparison crosses it."""
    n = len(text)
    ends = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-width] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = new
        if rank[order[-1]] == n - 1 or width >= n:
            return order
        width *= 2


class FMIndex:
    """Index of ``text``: runs of ids from 1 up to ``alphabet``, each run closed by a 0."""

    def __init__(self, text: np.ndarray, alphabet: int):
        self.n = len(text)
        order = suffix_array(text)
        last = text[order - 1]
        last = np.where(order == 0, 0, last)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet + 1))])
        self.depth = max(1, int(alphabet).bit_length())
        self.levels, self.zeros = [], []
        seq = last.astype(np.int64)
        for k in range(self.depth - 1, -1, -1):
            bit = (seq >> k) & 1 > 0
            self.levels.append(Bits(bit))
            self.zeros.append(int((~bit).sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])
        # a suffix is sampled at every SAMPLE-th position and at the start of a run, so
        # walking back never crosses a 0
        kept = (order % SAMPLE == 0) | (last == 0)
        self.marked, self.samples = Bits(kept), order[kept]

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` among the first i of the last column."""
        lo = np.zeros(len(i), np.int64)
        for k, level, zeros in zip(range(self.depth - 1, -1, -1), self.levels, self.zeros):
            one = (symbol >> k) & 1 > 0
            a, b = level.ones(lo), level.ones(i)
            lo, i = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, i - b)
        return i - lo

    def symbol(self, i: np.ndarray) -> np.ndarray:
        """The last column at i."""
        out = np.zeros(len(i), np.int64)
        for level, zeros in zip(self.levels, self.zeros):
            one = level.at(i)
            a = level.ones(i)
            out = out << 1 | one
            i = np.where(one, zeros + a, i - a)
        return out

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns, given right-aligned in a matrix padded with 0."""
        last = patterns[:, -1]
        lo, hi = self.first[last], self.first[last + 1]
        for k in range(2, patterns.shape[1] + 1):
            live = np.flatnonzero((lengths >= k) & (lo < hi))
            if not len(live):
                break
            c = patterns[live, -k]
            lo[live] = self.first[c] + self.rank(c, lo[live])
            hi[live] = self.first[c] + self.rank(c, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, walking back to the next sampled suffix."""
        out = np.zeros(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            done = self.marked.at(at)
            out[todo[done]] = self.samples[self.marked.ones(at[done])] + steps
            todo, at = todo[~done], at[~done]
            c = self.symbol(at)
            at = self.first[c] + self.rank(c, at)
            steps += 1
        return out
