"""Numpy kernels over UTF-8 text: words, word hashes, shingles. No Python object per word."""

from __future__ import annotations

import numpy as np

#: Odd multipliers with bits spread over all 64 places.
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BASE = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed 64-bit numbers, others for each salt."""
    return mix(np.uint64(salt * _STEP & _MASK) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_STEP))


#: A value for each byte; A-Z have those of a-z.
BYTE = seeds(256, 1)
BYTE[65:91] = BYTE[97:123]
#: White space of the contracts: x20 and x09-x0D.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
WORD = ~SPACE
#: Words of letters and digits: every byte outside x00-x2F, x3A-x60 (A-Z count as a-z) and x7B-x7F.
ALNUM = np.ones(256, bool)
ALNUM[0x00:0x30] = ALNUM[0x3A:0x41] = ALNUM[0x5B:0x61] = ALNUM[0x7B:0x80] = False

#: Bytes that are hashed at once.
PART = 1 << 20

_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse power modulo 2**64, for i < n."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(20, (n - 1).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        _powers = tuple(np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (_BASE, inverse))
    return _powers


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of each word and the n+1 offsets of the documents' words among them."""
    w = np.zeros(len(data) + 2, bool)
    w[1:-1] = inside[data]
    first, last = w[1:-1] & ~w[:-2], w[1:-1] & ~w[2:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    if len(cut):  # a document's end ends a word
        both = cut[w[cut] & w[cut + 1]]
        first[both], last[both - 1] = True, True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE) -> np.ndarray:
    """A 64-bit hash of the bytes from each start to its end; BYTE makes A-Z lower-case."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):  # parts of whole words, so that a text of any length needs tables of PART or of its longest word
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PART, side="right")))
        at, to = starts[i:j] - starts[i], ends[i:j] - starts[i]
        part = data[starts[i] : ends[j - 1]]
        power, inverse = powers(len(part) + 1)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[part] * power[: len(part)], out=sums[1:])
        out[i:j] = mix((sums[to] - sums[at]) * inverse[at] + (to - at).astype(np.uint64))
        i = j
    return out


def windows(hashes: np.ndarray, bounds: np.ndarray, k: int, salt: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of each document and their n+1 offsets.

    A document of 1 to k-1 words has one window, its whole sequence; one without words has none.
    """
    c = seeds(k, salt)
    n = np.diff(bounds)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    out_bounds = np.r_[0, np.cumsum(count)]
    if len(hashes) >= k:
        full = hashes[: len(hashes) - k + 1] * c[0]
        for j in range(1, k):
            full += hashes[j : len(hashes) - k + 1 + j] * c[j]
    else:
        full = np.zeros(0, np.uint64)
    start = np.repeat(bounds[:-1] - out_bounds[:-1], count) + np.arange(out_bounds[-1])
    short = np.flatnonzero((n > 0) & (n < k))
    out = np.zeros(out_bounds[-1], np.uint64)
    is_full = np.ones(out_bounds[-1], bool)
    is_full[out_bounds[:-1][short]] = False
    out[is_full] = full[start[is_full]]
    for d in short:
        out[out_bounds[d]] = (int((hashes[bounds[d] : bounds[d + 1]] * c[: n[d]]).sum(dtype=np.uint64)) + int(n[d]) * _STEP) & _MASK
    return mix(out), out_bounds
