"""A compressed full-text index of word numbers: wavelet matrix over the BWT, backward search for many patterns at once.

Suffixes are sorted by their first ``depth`` words only; backward search is exact for patterns up to that
length, because a step needs the order of one word less than the pattern has.
"""

from __future__ import annotations

import numpy as np


class BitRank:
    """Bits in 64-bit words with running counts: ones before any position in one gather and one popcount."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        words[: len(packed)] = packed
        self.words = words.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))[:-1]]).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, top: int):
        self.levels, now = [], symbols
        self.shifts = range(max(1, int(top).bit_length()) - 1, -1, -1)
        for shift in self.shifts:
            bit = (now >> shift) & 1 == 1
            self.levels.append((BitRank(bit), int(len(now) - bit.sum())))
            now = np.concatenate([now[~bit], now[bit]])
        every = np.arange(top + 1)
        self.base = self._walk(every, np.zeros(top + 1, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, (rank, zeros) in zip(self.shifts, self.levels):
            ones = rank.ones(at)
            at = np.where((symbol >> shift) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self._walk(symbol, at) - self.base[symbol]


def prefix_ranks(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all suffixes by their first depth - 1 and depth words, by doubling; the end counts as word 0."""

    def pair(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
        moved = np.zeros_like(b)
        moved[: len(b) - shift] = b[shift:] + 1
        return np.unique(a * np.int64(b.max() + 2) + moved, return_inverse=True)[1].astype(np.int64)

    rank, size, made = text.astype(np.int64), 1, {1: text.astype(np.int64)}
    while size * 2 <= depth - 1:
        rank, size = pair(rank, rank, size), size * 2
        made[size] = rank
    short = pair(rank, rank, depth - 1 - size) if depth - 1 > size else rank
    return short, pair(short, text.astype(np.int64), depth - 1)


class FMIndex:
    """Index of ``text``: word numbers from 1, with 0 behind every piece."""

    def __init__(self, text: np.ndarray, depth: int):
        self.depth, top = depth, int(text.max(initial=0))
        short, full = prefix_ranks(text, depth)
        order = np.argsort(full, kind="stable")  # equal prefixes stay in text order
        self.bwt = WaveletMatrix(text[order - 1], top)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        # of each row: the rows that share depth - 1 words, and the first place in the text that shares depth words
        shared = short[order]
        cuts = np.flatnonzero(np.diff(shared, prepend=-1))
        group = np.cumsum(np.diff(shared, prepend=-1) != 0) - 1
        self.low, self.high = cuts[group], np.append(cuts[1:], len(text))[group]
        whole = full[order]
        starts = np.flatnonzero(np.diff(whole, prepend=-1))
        self.earliest = order[starts][np.cumsum(np.diff(whole, prepend=-1) != 0) - 1]

    def step(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the patterns with ``word`` put in front."""
        return self.first[word] + self.bwt.rank(word, low), self.first[word] + self.bwt.rank(word, high)

    def earliest_windows(self, pieces: list[np.ndarray]):
        """The earliest place in the text of each run of ``depth`` words of ``pieces``, which are parts of the text.

        All pieces are read from right to left together; yields (piece, first word, place) arrays.
        """
        sizes = np.array([len(p) for p in pieces])
        order = np.argsort(-sizes, kind="stable")
        flat, ends = np.concatenate([pieces[i] for i in order]), np.cumsum(sizes[order])
        low, high = np.zeros(len(order), np.int64), np.full(len(order), len(self.low), np.int64)
        for t in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(-sizes[order], -t, "left"))  # pieces with more than t words
            word = flat[ends[:n] - 1 - t]
            a, b = self.step(word, low[:n], high[:n])
            if t + 1 >= self.depth:
                yield order[:n], sizes[order[:n]] - 1 - t, self.earliest[a]
                # drop the last word: all rows that share the first depth - 1
                a, b = self.low[a], self.high[a]
            low[:n], high[:n] = a, b
