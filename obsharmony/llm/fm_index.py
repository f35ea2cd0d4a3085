"""A compressed FM-index over word sequences: backward search on a wavelet matrix.

The index holds the last column of the sorted suffixes as a wavelet matrix of packed bits,
with one running count per 64 bits, the lengths of common prefixes of neighbouring
suffixes, and the smallest owner of any range of suffixes. Queries run in lanes, all at
once: each lane reads its sequence from the right and keeps the longest match that an owner
smaller than its own has (the matching statistics).
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A packed bit vector with counts of ones before a place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.frombuffer(packed.tobytes() + bytes(-len(packed) % 8 + 8), "<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """Counts of a symbol before a place, one bit of the symbol per level."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.depth = max(1, int(top).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for d in reversed(range(self.depth)):
            bit = (symbols >> d & 1).astype(bool)
            self.levels.append((Bits(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for (bits, zeros), d in zip(self.levels, reversed(range(self.depth))):
            ones = bits.ones(at)
            at = np.where(symbol >> d & 1, zeros + ones, at - ones)
        return at


class FMIndex:
    """Index of sequences (arrays of 64-bit words), each with an owner."""

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray):
        m = len(sequences)
        self.known = np.unique(np.concatenate([np.zeros(0, np.uint64), *sequences]))
        # Every sequence ends in a symbol of its own, below all words, so suffixes never tie.
        text = np.concatenate([x for i, s in enumerate(sequences) for x in (np.searchsorted(self.known, s) + m, [i])]).astype(np.int64)
        owner = np.repeat(np.arange(m), [len(s) + 1 for s in sequences])
        ranks = self._ranks(text)
        order = np.argsort(ranks[-1])
        last = text[order - 1] - m + 1  # 1.. for words, 0 or less for an end
        last = np.maximum(last, 0)
        self.n = len(text)
        self.wavelet = Wavelet(last, len(self.known))
        counts = np.bincount(last, minlength=len(self.known) + 1)
        # Suffixes that start with an end symbol come first, m of them.
        self.start = np.concatenate([[0], m + np.cumsum(counts[1:]) - counts[1:]])
        symbols = np.arange(len(self.known) + 1)
        self.base = self.wavelet.down(symbols, np.zeros(len(symbols), np.int64))
        self.common = self._common(order, ranks)
        del ranks
        self.left, self.right = self._smaller(self.common)
        self.smallest = self._minima(np.asarray(owners)[owner[order]])

    @staticmethod
    def _ranks(text: np.ndarray) -> list[np.ndarray]:
        """Ranks of suffixes by their first 1, 2, 4, ... symbols, until all differ."""
        ranks = [np.unique(text, return_inverse=True)[1]]
        step = 1
        while ranks[-1].max(initial=0) < len(text) - 1:
            r = ranks[-1]
            then = np.zeros(len(r), np.int64)
            then[:-step] = r[step:] + 1
            ranks.append(np.unique(r * (len(r) + 1) + then, return_inverse=True)[1])
            step *= 2
        return ranks

    @staticmethod
    def _common(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each sorted suffix and the one before; -1 at both ends."""
        n = len(order)
        a, b, out = order[:-1].copy(), order[1:].copy(), np.zeros(max(0, n - 1), np.int64)
        for k in reversed(range(len(ranks) - 1)):
            inside = np.flatnonzero((a < n) & (b < n))
            same = inside[ranks[k][a[inside]] == ranks[k][b[inside]]]
            out[same] += 1 << k
            a[same] += 1 << k
            b[same] += 1 << k
        return np.concatenate([[-1], out, [-1]])

    @staticmethod
    def _smaller(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest places to the left and right with a smaller value (ends stand for themselves)."""

        def one_way(v: np.ndarray) -> np.ndarray:
            at = np.maximum(np.arange(len(v)) - 1, 0)
            open_ = np.arange(1, len(v))
            while len(open_):
                open_ = open_[(v[at[open_]] >= v[open_]) & (at[open_] > 0)]
                at[open_] = at[at[open_]]
            return at

        return one_way(v), len(v) - 1 - one_way(v[::-1])[::-1]

    @staticmethod
    def _minima(owner: np.ndarray) -> list[np.ndarray]:
        out, step = [owner], 1
        while 2 * step <= len(owner):
            out.append(np.minimum(out[-1][:-step], out[-1][step:]))
            step *= 2
        return out

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest owner among the suffixes lo to hi - 1 (lo < hi)."""
        level = np.frexp((hi - lo).astype(float))[1] - 1
        out = np.empty(len(lo), self.smallest[0].dtype)
        for k in np.unique(level):
            at = level == k
            table = self.smallest[k]
            out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << int(k))])
        return out

    def matching(self, queries: list[np.ndarray], owners: np.ndarray) -> list[np.ndarray]:
        """For each place of each query, the longest match from there that a smaller owner has."""
        lengths = np.array([len(q) for q in queries], np.int64)
        first = np.cumsum(lengths) - lengths
        words = np.concatenate([np.zeros(0, np.uint64), *queries])
        symbol = np.searchsorted(self.known, words)
        found = np.minimum(symbol, max(0, len(self.known) - 1))
        symbol = np.where(self.known[found] == words, symbol + 1, 0) if len(self.known) else np.zeros(len(words), np.int64)
        out = np.zeros(len(words), np.int64)
        place = first + lengths - 1
        lo, hi, size = np.zeros(len(queries), np.int64), np.full(len(queries), self.n), np.zeros(len(queries), np.int64)
        own = np.asarray(owners)
        lanes = np.flatnonzero(lengths > 0)
        while len(lanes):
            s = symbol[place[lanes]]
            base = self.start[s] - self.base[s]
            a, b = self.wavelet.down(s, lo[lanes]) + base, self.wavelet.down(s, hi[lanes]) + base
            good = (s > 0) & (a < b)
            good[good] = self.least(a[good], b[good]) < own[lanes[good]]
            took = lanes[good]
            lo[took], hi[took] = a[good], b[good]
            size[took] += 1
            out[place[took]] = size[took]
            place[took] -= 1
            # The others give up words at the right end of their match, or the word if none is left.
            rest, word = lanes[~good], s[~good]
            empty = (size[rest] == 0) | (word == 0)
            none = rest[empty]
            place[none] -= 1
            lo[none], hi[none], size[none] = 0, self.n, 0
            shorter = rest[~empty]
            l, r = lo[shorter], hi[shorter]
            edge = np.where(self.common[l] >= self.common[r], l, r)
            length = np.maximum(self.common[edge], 0)
            root = length == 0
            lo[shorter] = np.where(root, 0, self.left[edge])
            hi[shorter] = np.where(root, self.n, self.right[edge])
            size[shorter] = length
            lanes = lanes[place[lanes] >= first[lanes]]
        return np.split(out, np.cumsum(lengths)[:-1]) if len(queries) else []
