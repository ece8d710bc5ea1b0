"""Tokens for the classifiers: runs of letters, of digits and of symbols, hashed."""

from __future__ import annotations

import numpy as np

from . import kernel as K

_KIND = np.full(256, 3, np.uint8)
_KIND[K.SPACE] = 0
_KIND[97:123] = _KIND[65:91] = _KIND[128:] = 1
_KIND[48:58] = 2


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens, A-Z lower-cased and all numbers alike, and the n+1 offsets of the texts' tokens."""
    kind = np.zeros(len(data) + 2, np.uint8)
    kind[1:-1] = _KIND[data]
    change = kind[1:] != kind[:-1]
    change[offsets] = True
    edge = np.flatnonzero(change)
    inside = kind[1:][edge[:-1]] > 0
    starts, ends = edge[:-1][inside], edge[1:][inside]
    h = K.word_hashes(data, starts, ends)
    h[_KIND[data[starts]] == 2] = 0
    return h, np.searchsorted(starts, offsets)


def buckets(h: np.ndarray, bits: int) -> np.ndarray:
    """The highest bits of hashes, as indices."""
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def distinct(b: np.ndarray, bounds: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of each text, sorted, and their n+1 offsets."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    both = np.unique(doc << bits | b)
    return both & ((1 << bits) - 1), np.searchsorted(both >> bits, np.arange(len(bounds)))


def sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the rows of x between bounds; 0 where there are none."""
    out = np.zeros((len(bounds) - 1, *x.shape[1:]), np.float64)
    some = bounds[:-1] < bounds[1:]
    if some.any():
        out[some] = np.add.reduceat(x, bounds[:-1][some], axis=0)
    return out
