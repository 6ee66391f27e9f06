"""Two-stage suffix sorting and common prefixes of a byte block, in numpy.

Only the suffixes smaller than their successors are sorted directly. The
others are induced by one scan over the buckets of first bytes, in
ascending order: a suffix placed there puts the suffix one byte longer, if
that is not smaller than it, at the next free place of its own bucket. The
order holds for the first ``depth`` bytes; ties beyond are arbitrary.
"""

from __future__ import annotations

import numpy as np


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the end of
    the block is smaller than any byte."""
    n = len(data)
    if not n:
        return np.zeros(0, bool)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
    step[-1] = -1
    # a run of equal bytes is decided by the byte after it
    place = np.where(step != 0, np.arange(n), n)
    decided = np.minimum.accumulate(place[::-1])[::-1]
    return step[decided] > 0


def packed_words(data: np.ndarray, beyond: int) -> np.ndarray:
    """The eight bytes from each place on, as one little-endian number; zeros
    stand for ``beyond`` bytes after the end."""
    padded = np.concatenate([data, np.zeros(beyond + 8, np.uint8)])
    return np.ndarray(len(data) + beyond, "<u8", padded, strides=(1,)).astype(np.uint64)


def sorted_places(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """The (ascending) places in the order of the ``depth`` bytes from each on: by
    their first packed word, then groups that tie by the next one. Of
    suffixes that differ by zeros at the end only, the shorter comes first."""
    order = places[::-1]  # a shorter suffix begins later
    keys = words[order].byteswap()
    by = np.argsort(keys, kind="stable")
    order, keys = order[by], keys[by]
    tied = np.arange(len(order))
    group = np.zeros(len(order), np.int64)
    for at in range(8, depth + 8, 8):
        g = group[tied]
        head = np.ones(len(tied), bool)
        head[1:] = (g[1:] != g[:-1]) | (keys[1:] != keys[:-1])
        group[tied] = tied[head][np.cumsum(head) - 1]
        alone = head & np.append(head[1:], True)
        tied = tied[~alone]
        if at >= depth or not len(tied):
            break
        keys = words[order[tied] + at].byteswap()
        g = group[tied]
        unlike = np.flatnonzero((g[1:] == g[:-1]) & (keys[1:] != keys[:-1]))
        if len(unlike):  # groups that agree once more stay as they are
            mixed = np.zeros(len(order), bool)
            mixed[g[unlike]] = True
            part = np.flatnonzero(mixed[g])
            by = part[np.lexsort((keys[part], g[part]))]
            order[tied[part]], keys[part] = order[tied[by]], keys[by]
    return order


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Start places of all suffixes in ascending order of ``depth`` bytes."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    small = smaller_than_next(data)
    counts = np.bincount(data, minlength=256)
    head = np.cumsum(counts) - counts  # next free place of induced suffixes
    order = np.full(n, -1, np.int64)
    direct = sorted_places(np.flatnonzero(small), packed_words(data, depth + 8), depth)
    per = np.bincount(data[direct], minlength=256) if len(direct) else np.zeros(256, np.int64)
    tail = head + counts - per  # sorted ones fill the end of each bucket
    starts = np.cumsum(per) - per

    def induce(found: np.ndarray) -> np.ndarray:
        """Place the predecessors of suffixes, given in order; return those
        that fell into the bucket being scanned."""
        before = found[found > 0] - 1
        before = before[~small[before]]
        if not len(before):
            return before
        byte = data[before]
        by = np.argsort(byte, kind="stable")
        moved, keys = before[by], byte[by]
        new = np.bincount(byte, minlength=256)
        at = head[keys] + np.arange(len(keys)) - np.repeat(np.cumsum(new) - new, new)
        order[at] = moved
        head[:] += new
        return before[byte == bucket]

    bucket = int(data[-1])
    first = head[bucket]
    order[first] = n - 1  # follows the empty suffix, the least of all
    head[bucket] += 1
    begin = np.cumsum(counts) - counts
    for bucket in np.flatnonzero(counts).tolist():
        todo = order[begin[bucket] : head[bucket]]
        while len(todo):
            todo = induce(todo)
        own = direct[starts[bucket] : starts[bucket] + per[bucket]]
        order[tail[bucket] : tail[bucket] + per[bucket]] = own
        induce(own)
    return order


def adjacent_common(data: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Length, up to ``limit``, of the common prefix of each suffix in the
    order with the one before it (0 for the first). Compared eight bytes at
    a time, by those pairs that still agree."""
    n = len(data)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    words = packed_words(data, limit + 8)
    a, b = order[:-1], order[1:]
    live = np.arange(n - 1)
    done = np.zeros(n - 1, np.int64)
    for at in range(0, limit, 8):
        differ = words[a[live] + at] ^ words[b[live] + at]
        same = differ == 0
        stop = live[~same]
        # little-endian words: the lowest set byte is the first that differs
        low = differ[~same] & (~differ[~same] + np.uint64(1))
        done[stop] = at + (np.log2(low.astype(np.float64)) // 8).astype(np.int64)
        live = live[same]
        if not len(live):
            break
    done[live] = limit
    # padding past the end of the block matches nothing
    out[1:] = np.minimum(np.minimum(done, limit), n - np.maximum(a, b))
    return out
