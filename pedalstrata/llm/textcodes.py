"""Words of many texts at once, as arrays of code points: no Python object per word.

A word is a run of letters and digits of the lower-cased text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


@cache
def kinds() -> np.ndarray:
    """Per code point 0 for other, 1 for a digit or the like, 2 for a letter."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            out[c] = 2
        elif s.isalnum():
            out[c] = 1
    return out


@dataclass
class Words:
    """``codes`` of all texts in a row with one line break after each; words by start and length;
    ``text`` the number of the text that a word lies in; ``n_texts``."""

    codes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    text: np.ndarray
    n_texts: int

    def bounds(self) -> np.ndarray:
        """Words before each text, and at the end all words."""
        return np.searchsorted(self.text, np.arange(self.n_texts + 1))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        # The code points of the words alone, each with its place in its word.
        total = int(self.lengths.sum())
        first = np.cumsum(self.lengths) - self.lengths
        place = np.arange(total) - np.repeat(first, self.lengths)
        codes = self.codes[place + np.repeat(self.starts, self.lengths)].astype(np.uint64)
        return mix(np.add.reduceat(mix(codes + (place.astype(np.uint64) << np.uint64(21)) + _GOLDEN), first))


def words(texts: list[str | None], least: int = 1) -> Words:
    """The words of the texts; with ``least`` 2 words are runs of letters only."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = kinds()[codes] >= least
    step = np.diff(inside)
    starts, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    return Words(codes, starts, stops - starts, np.searchsorted(ends, starts, side="right"), len(lowered))


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every run of ``size`` words; all words of a shorter text form one."""
    h = w.hashes()
    if not len(h):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    bounds = w.bounds()
    end = bounds[w.text + 1]
    at = np.arange(len(h))
    heads = np.flatnonzero((at + size <= end) | (at == bounds[w.text]))
    out = np.zeros(len(heads), np.uint64)
    factor = int(_GOLDEN)
    for j in range(size):
        there = heads + j
        term = h[np.minimum(there, len(h) - 1)]
        if j:
            term = np.where(there < end[heads], term, np.uint64(0))
        out += term * np.uint64(factor)
        factor = factor * int(_MIX[0]) % 2**64 | 1
    return mix(out), w.text[heads]
