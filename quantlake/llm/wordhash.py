"""Words of whole texts as 64-bit hashes, a batch at a time in numpy.

A word is a run of bytes other than space and \\x09-\\x0D, as the pattern [^\\x20\\x09-\\x0D]+ has it. Its hash is
a polynomial over random byte values modulo 2^64, taken from running sums, then scrambled; equal words have
equal hashes, and two different words of a corpus share one with probability about 2^-64.
"""

from __future__ import annotations

import numpy as np

#: Bytes handled at once; a longer text is cut between words.
CHUNK = 400_000

_RANDOM = np.random.default_rng(20240607)
_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def scramble(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which close inputs are far apart."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Words:
    """Hashes the words of batches of texts; keeps its tables of powers between batches."""

    def __init__(self, lower: bool = False):
        self.values = _VALUE[_LOWER] if lower else _VALUE
        self.up, self.down = powers(_BASE, 1), powers(_INVERSE, 1)

    def _chunk(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and start bytes of the words of ``raw``, which ends between words."""
        if len(self.up) <= len(raw):
            self.up, self.down = powers(_BASE, len(raw) + 1), powers(_INVERSE, len(raw) + 1)
        word = ~_GAP[raw]
        edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
        start, end = edge[::2], edge[1::2]
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.values[raw] * self.up[: len(raw)], out=sums[1:])
        return scramble((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64)), start

    def of(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """All word hashes of ``texts`` in order, and the number of words of each text."""
        coded = [t.encode("utf-8", "surrogatepass") + b" " for t in texts]
        ends = np.cumsum([len(c) for c in coded])
        raw = np.frombuffer(b"".join(coded), np.uint8)
        hashes, starts, at = [], [], 0
        while at < len(raw):
            stop = min(at + CHUNK, len(raw))
            while stop < len(raw) and not _GAP[raw[stop - 1]]:
                more = np.flatnonzero(_GAP[raw[stop : stop + CHUNK]])
                stop = stop + int(more[0]) + 1 if len(more) else min(len(raw), stop + CHUNK)
            h, s = self._chunk(raw[at:stop])
            hashes.append(h)
            starts.append(s + at)
            at = stop
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        upto = np.searchsorted(s, ends)
        return h, np.diff(upto, prepend=0)


_MIX = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def joined(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (by first word; runs may cross texts)."""
    n = max(0, len(h) - size + 1)
    out = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        out += scramble(h[k : k + n] + _MIX[k]) * _MIX[(k + 7) % 64] if size <= 8 else h[k : k + n] * _MIX[k % 64]
    return scramble(out)


def shingle_sets(words: Words, texts, size: int):
    """For each text the sorted distinct hashes of its runs of ``size`` words; fewer words: one hash of them all."""
    h, counts = words.of(texts)
    runs, at = joined(h, size), 0
    for n in counts:
        if n >= size:
            yield np.unique(runs[at : at + n - size + 1])
        elif n:
            yield joined(h[at : at + n], int(n))
        else:
            yield np.zeros(0, np.uint64)
        at += n
