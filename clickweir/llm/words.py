"""Words of flat byte arrays, found and hashed with numpy.

A word is a run of ASCII letters (folded to lower case), of all bytes above
0x7F and, for ``WORDS``, of digits: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
after A-Z are lower-cased. Words never cross a row.
"""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x100000001B3)


def _fold(digits: bool) -> np.ndarray:
    b = np.arange(256, dtype=np.uint8)
    out = np.zeros(256, np.uint8)
    for lo, hi in ((97, 122), (128, 255), *(((48, 57),) if digits else ())):
        out[lo : hi + 1] = b[lo : hi + 1]
    out[65:91] = b[97:123]
    return out


WORDS = _fold(digits=True)
LETTERS = _fold(digits=False)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash (in place where possible)."""
    h = h * MIX
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def powers(n: int) -> np.ndarray:
    p = np.full(max(n, 1), BASE, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def find_words(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, length and 64-bit hash of every word, words per row)."""
    n_rows = len(offsets) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(n_rows, np.int64)
    folded = fold[data]
    inside = folded > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = heads[1:] - 1
    last[tails] = inside[tails]
    start = np.flatnonzero(first)
    length = np.flatnonzero(last) - start + 1
    if not len(start):
        return start, length, np.zeros(0, np.uint64), np.zeros(n_rows, np.int64)
    chars = folded[inside].astype(np.uint64)
    ends = np.cumsum(length)
    tops = ends - length
    place = np.arange(len(chars)) - np.repeat(tops, length)
    chars += np.uint64(1)
    chars *= powers(int(length.max()))[place]
    hashes = mix(np.add.reduceat(chars, tops))
    return start, length, hashes, np.diff(np.searchsorted(start, offsets))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive word hashes (rows not respected)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out *= BASE
        out += words[k : n + k]
    return mix(out)


def row_shingles(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, shingles per row); a row of fewer words, but not
    none, has one shingle of all its words."""
    ends = np.cumsum(counts)
    full = shingle_hashes(words, size)
    per_row = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out = np.zeros(int(per_row.sum()), np.uint64)
    put = np.cumsum(per_row) - per_row
    long = counts >= size
    if long.any():
        n = per_row[long]
        total = np.arange(int(n.sum()))
        step = np.repeat(np.cumsum(n) - n, n)
        out[total - step + np.repeat(put[long], n)] = full[total - step + np.repeat((ends - counts)[long], n)]
    for i in np.flatnonzero((counts > 0) & ~long):
        part = words[ends[i] - counts[i] : ends[i]]
        out[put[i]] = shingle_hashes(part, len(part))[0] ^ np.uint64(len(part))
    return out, per_row
