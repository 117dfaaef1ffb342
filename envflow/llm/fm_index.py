"""FM-index over a sequence of integer symbols, in numpy.

The text is a concatenation of runs, each closed by symbol 0. Closing symbols sort
before all others and among themselves by place, so no suffix compares past its run.
``ranges`` searches many patterns backward at once, by ranks in a wavelet matrix over
the Burrows-Wheeler transform; ``locate`` walks back to sampled suffix positions.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the sorted suffixes, by prefix doubling."""
    n = len(text)
    ends = text == 0
    closed = int(ends.sum())
    rank = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + closed)
    # dense ranks, so that two fit one key
    _, rank = np.unique(rank, return_inverse=True)
    rank = rank.astype(np.int64)
    step = 1
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class BitVector:
    """Bits with constant-time ranks: a count per 64 bits and a popcount."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros(-(-(n + 1) // 64) * 64, dtype=np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Set bits before place i."""
        w = i >> 6
        mask = (_U(1) << (i & 63).astype(_U)) - _U(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(_U)) & _U(1)


class WaveletMatrix:
    """Ranks of any symbol: one bit vector for each bit of the symbols, high bits first."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels = []
        cur = symbols.astype(np.int64)
        for b in reversed(range(max(1, int(largest).bit_length()))):
            bits = ((cur >> b) & 1).astype(np.uint8)
            self.levels.append((b, BitVector(bits), int(len(cur) - bits.sum())))
            cur = np.concatenate((cur[bits == 0], cur[bits == 1]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before place i."""
        low = np.zeros_like(i)
        high = i.copy()
        for b, bits, zeros in self.levels:
            one = ((symbol >> b) & 1).astype(bool)
            l1, h1 = bits.rank1(low), bits.rank1(high)
            low = np.where(one, zeros + l1, low - l1)
            high = np.where(one, zeros + h1, high - h1)
        return high - low

    def access(self, i: np.ndarray) -> np.ndarray:
        """The symbols at places i."""
        out = np.zeros_like(i)
        at = i.copy()
        for b, bits, zeros in self.levels:
            one = bits.get(at).astype(bool)
            r1 = bits.rank1(at)
            at = np.where(one, zeros + r1, at - r1)
            out |= one.astype(np.int64) << b
        return out


class FMIndex:
    def __init__(self, text: np.ndarray):
        """``text``: symbols of 1 and more, every run closed by 0."""
        self.n = len(text)
        largest = int(text.max(initial=1))
        order = suffix_array(text)
        self.bwt = WaveletMatrix(text[order - 1], largest)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=largest + 1)))).astype(np.int64)
        # sampled: every SAMPLE-th place of a run, its first one included, so walks stay in the run
        ends = np.flatnonzero(text == 0)
        starts = np.concatenate(([0], ends[:-1] + 1))
        run = np.repeat(np.arange(len(ends)), ends - starts + 1)
        sampled = (np.arange(self.n) - starts[run]) % SAMPLE == 0
        self.marked = BitVector(sampled[order].astype(np.uint8))
        self.samples = order[sampled[order]]

    def ranges(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges (low, high) of the rows of ``patterns``, which 0 pads on the left."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        for k in reversed(range(patterns.shape[1])):
            c = patterns[:, k].astype(np.int64)
            go = np.flatnonzero((c > 0) & (low < high))
            if not len(go):
                break
            s = c[go]
            known = s < len(self.first) - 1
            lost = go[~known]
            high[lost] = low[lost]
            go, s = go[known], s[known]
            low[go], high[go] = self.first[s] + self.bwt.rank(s, low[go]), self.first[s] + self.bwt.rank(s, high[go])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of the suffixes in ``rows``."""
        out = np.empty(len(rows), dtype=np.int64)
        at, left, steps = rows.copy(), np.arange(len(rows)), 0
        while len(left):
            hit = self.marked.get(at).astype(bool)
            out[left[hit]] = self.samples[self.marked.rank1(at[hit])] + steps
            at, left = at[~hit], left[~hit]
            if len(left):
                s = self.bwt.access(at)
                at = self.first[s] + self.bwt.rank(s, at)
                steps += 1
        return out
