"""FM-index over an integer sequence: suffix order, Burrows-Wheeler transform,
wavelet ranks and sampled suffix positions, all searches done for many patterns
at once."""

from __future__ import annotations

import numpy as np

from .common import runs


def suffix_order(seq: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Start positions of all suffixes in order (a shorter suffix first), by
    prefix doubling; each round sorts only the suffixes that still tie. With a
    `depth`, suffixes that agree in so many symbols may stay in any order."""
    n = len(seq)
    bits = max(1, int(seq.max()).bit_length()) if n else 1
    k = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for j in range(k):  # the first k symbols as one number
        key <<= bits
        key[:max(0, n - j)] |= seq[j:]
    order = np.argsort(key, kind="stable")
    rank = np.zeros(n + 1, np.int64)
    first = runs(key[order])
    rank[order] = np.repeat(first, np.diff(np.append(first, n))) + 1
    while depth is None or k < depth:
        size = np.diff(np.append(first, n))
        tied = np.repeat(size > 1, size)
        if not tied.any():
            return order
        at = np.flatnonzero(tied)
        sub = order[at]
        ahead, own = rank[np.minimum(sub + k, n)], rank[sub]
        by = np.argsort(own * (n + 1) + ahead, kind="stable")
        sub, ahead, own = sub[by], ahead[by], own[by]
        order[at] = sub
        start = runs(own, ahead)
        rank[sub] = np.repeat(at[start], np.diff(np.append(start, len(at)))) + 1
        keep = np.zeros(n, bool)
        keep[first[size == 1]] = True
        keep[at[start]] = True
        first = np.flatnonzero(keep)
        k *= 2
    return order


class Wavelet:
    """Ranks of symbols in prefixes of a sequence: one packed bit vector per
    bit of the symbols, the sequence parted stably by that bit at each level."""

    def __init__(self, seq: np.ndarray):
        self.levels = max(1, int(seq.max()).bit_length()) if len(seq) else 1
        self.n = len(seq)
        self._start: np.ndarray | None = None
        self.words, self.before, self.zeros = [], [], []
        for level in range(self.levels):
            bit = (seq >> (self.levels - 1 - level)) & 1
            padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
            padded[:self.n] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.before.append(np.cumsum(counts) - counts)
            self.zeros.append(self.n - int(counts.sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        word, low = i >> 6, (i & 63).astype(np.uint64)
        part = self.words[level][word] & ((np.uint64(1) << low) - np.uint64(1))
        return self.before[level][word] + np.bitwise_count(part)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the first i places."""
        a, b = np.zeros(len(i), np.int64), i
        for level in range(self.levels):
            one = (symbol >> (self.levels - 1 - level)) & 1 > 0
            oa, ob = self._ones(level, a), self._ones(level, b)
            a = np.where(one, self.zeros[level] + oa, a - oa)
            b = np.where(one, self.zeros[level] + ob, b - ob)
        return b - a

    def extend(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All symbols in the ranges [a, b): for each range and symbol in it
        (symbol, its rank at a, its rank at b)."""
        symbol = np.zeros(len(a), np.int64)
        for level in range(self.levels):
            oa, ob = self._ones(level, a), self._ones(level, b)
            za, zb = a - oa, b - ob
            zero, one = zb > za, ob > oa
            z = self.zeros[level]
            symbol = np.concatenate([symbol[zero] << 1, symbol[one] << 1 | 1])
            a, b = np.concatenate([za[zero], z + oa[one]]), np.concatenate([zb[zero], z + ob[one]])
        start = self._starts()[symbol]
        return symbol, a - start, b - start

    def _starts(self) -> np.ndarray:
        if self._start is None:
            all_ = np.arange(1 << self.levels)
            at = np.zeros(len(all_), np.int64)
            for level in range(self.levels):
                one = (all_ >> (self.levels - 1 - level)) & 1 > 0
                ones = self._ones(level, at)
                at = np.where(one, self.zeros[level] + ones, at - ones)
            self._start = at
        return self._start

    def symbol(self, i: np.ndarray) -> np.ndarray:
        """The symbol at each place."""
        out = np.zeros(len(i), np.int64)
        for level in range(self.levels):
            one = (self.words[level][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) > 0
            ones = self._ones(level, i)
            out = out << 1 | one
            i = np.where(one, self.zeros[level] + ones, i - ones)
        return out


class FMIndex:
    """Index of a sequence of positive integers (0 ends it)."""

    SAMPLE = 8

    def __init__(self, seq: np.ndarray):
        seq = np.append(seq, 0).astype(np.int64)
        n = len(seq)
        order = suffix_order(seq)
        bwt = seq[order - 1]
        self.wavelet = Wavelet(bwt)
        counts = np.bincount(seq)
        self.less = np.cumsum(counts) - counts
        marked = order % self.SAMPLE == 0
        self.marks = Wavelet(marked.astype(np.int64))
        self.sampled = order[marked]
        self.n = n

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range [from, to) of each row of `patterns`, which all have
        one length; the range is empty if the pattern does not occur."""
        sp = np.zeros(len(patterns), np.int64)
        ep = np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[live, j]
            sp[live] = self.less[c] + self.wavelet.rank(c, sp[live])
            ep[live] = self.less[c] + self.wavelet.rank(c, ep[live])
            live = live[ep[live] > sp[live]]
            if not len(live):
                break
        ep = np.maximum(ep, sp)
        return sp, ep

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix: steps back through the transform up to
        the next sampled one."""
        out = np.zeros(len(rows), np.int64)
        live, at, steps = np.arange(len(rows)), rows, 0
        while len(live):
            hit = self.marks.symbol(at) > 0
            one = np.ones(int(hit.sum()), np.int64)
            out[live[hit]] = self.sampled[self.marks.rank(one, at[hit])] + steps
            live, at = live[~hit], at[~hit]
            c = self.wavelet.symbol(at)
            at = self.less[c] + self.wavelet.rank(c, at)
            steps += 1
        return out


def prefix_classes(seq: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, class): the suffixes of a sequence of positive integers in
    order, and for each a number that suffixes share if and only if their
    common prefix has at least `length` symbols.

    Breadth-first backward extension on the Burrows-Wheeler transform: from the
    range of a string w come the ranges of all cw; a range that ends where no
    range has ended before ends at a common prefix of exactly |w|. Common
    prefixes are found by increasing value; the search stops at `length`."""
    seq = np.append(seq, 0).astype(np.int64)
    n = len(seq)
    order = suffix_order(seq, length + 1)
    wavelet = Wavelet(seq[order - 1])
    counts = np.bincount(seq, minlength=1 << wavelet.levels)
    less = np.cumsum(counts) - counts
    ended = np.zeros(n + 1, bool)
    a, b = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(length):
        c, ra, rb = wavelet.extend(a, b)
        a, b = less[c] + ra, less[c] + rb
        new = ~ended[b]
        a, b = a[new], b[new]
        if not len(a):
            break
        # of ranges that end together the widest stands for all
        by = np.lexsort((a, b))
        a, b = a[by], b[by]
        first = runs(b)
        a, b = a[first], b[first]
        ended[b] = True
    return order, np.cumsum(ended[:n])
