"""Benchmark decontamination: prefix-filtered containment join.

An item's windows are its runs of ``window`` consecutive words (a shorter
item, if it has words, is one window). A window is the set of its shingles
of five words; a document that holds the window holds every one of them, so
the necessary prefix of the window, with shingles ordered by rarity in the
documents, is its single rarest shingle. Documents are probed for prefix shingles
only; position and length bounds place the window around a match, and the
window is then verified word by word.

The items are taken in blocks of at most ``block_bytes`` of text (by a hash),
and only the index of one block is broadcast at a time; each further block is
another pass over the documents with the spans found so far.

Null and empty texts have no words: no hits. Repeated documents and null
ids are kept, each row judged alone. Repeated items count once by id; an item
with a null id marks words as hit but is not listed. No items: nothing hit.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.llm.common import flat_text, row_pieces, starts_to_index, written
from clickweir.llm.words import find_words, shingle_hashes

WINDOW = 13
SHINGLE = 5
BLOCK_BYTES = 16 << 20
FILTER_BITS = 22


class KeySet:
    """Sorted 64-bit keys behind a bit table that rejects most probes."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.table = np.zeros(1 << FILTER_BITS, bool)
        self.table[self.keys >> np.uint64(64 - FILTER_BITS)] = True

    def find(self, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``probes``, indices in ``keys``) of the probes found."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.table[probes >> np.uint64(64 - FILTER_BITS)])
        index = np.minimum(np.searchsorted(self.keys, probes[at]), len(self.keys) - 1)
        same = self.keys[index] == probes[at]
        return at[same], index[same]


@dataclass
class Windows:
    """Distinct windows of a block of items."""

    words: np.ndarray  # (windows, window) word hashes, 0 beyond the length
    length: np.ndarray
    items: list[list[str]]  # ids of the items that have the window

    def shingles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, window, offset) of every shingle of every window."""
        keys, owner, offset = [], [], []
        for n in np.unique(self.length):
            rows = np.flatnonzero(self.length == n)
            size = min(SHINGLE, int(n))
            for o in range(int(n) - size + 1):
                keys.append(_sized(self.words[rows, o : o + size]))
                owner.append(rows)
                offset.append(np.full(len(rows), o))
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(keys), np.concatenate(owner), np.concatenate(offset)

    def shingle_sizes(self) -> list[int]:
        return sorted({min(SHINGLE, int(n)) for n in np.unique(self.length)})


def _sized(rows: np.ndarray) -> np.ndarray:
    """Shingle key of each row of word hashes; the size is part of the key."""
    n, size = rows.shape
    return shingle_hashes(np.ascontiguousarray(rows).reshape(-1), size)[::size] ^ np.uint64(size) if n else np.zeros(0, np.uint64)


def item_windows(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Windows:
    raw = [(t or "").encode("utf-8", "surrogatepass") for _, t in items]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    _, _, hashes, counts = find_words(np.frombuffer(b"".join(raw), np.uint8), off)
    found: dict[tuple, set] = {}
    ends = np.cumsum(counts)
    for (item, _), end, n in zip(items, ends.tolist(), counts.tolist(), strict=True):
        own = hashes[end - n : end].tolist()
        for i in range(max(1, n - window + 1) if n else 0):
            ids = found.setdefault(tuple(own[i : i + window]), set())
            if item is not None:
                ids.add(item)
    words = np.zeros((len(found), window), np.uint64)
    length = np.zeros(len(found), np.int64)
    for k, w in enumerate(found):
        words[k, : len(w)] = w
        length[k] = len(w)
    return Windows(words, length, [sorted(s) for s in found.values()])


@dataclass
class Prefixes:
    """Each window's necessary prefix, ready for probing."""

    windows: Windows
    keys: KeySet
    first: np.ndarray  # windows of key k: order[first[k] : first[k + 1]]
    order: np.ndarray
    offset: np.ndarray  # of the prefix shingle inside each window


def choose_prefixes(windows: Windows, keys: np.ndarray, counts: np.ndarray) -> Prefixes:
    """The rarest shingle of each window, given how often the ``keys``
    (sorted) occur in the documents; ties go to the smaller key."""
    key, owner, offset = windows.shingles()
    often = np.zeros(len(key), np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        often = np.where(keys[at] == key, counts[at], 0)
    rank = np.lexsort((offset, key, often, owner))
    pick = rank[np.unique(owner[rank], return_index=True)[1]] if len(rank) else rank
    prefix, place = key[pick], offset[pick]
    known = KeySet(prefix)
    group = np.searchsorted(known.keys, prefix)
    order = np.argsort(group, kind="stable")
    first = np.searchsorted(group[order], np.arange(len(known.keys) + 1))
    return Prefixes(windows, known, first, order, place)


def _probe(hashes: np.ndarray, sizes: list[int], keys: KeySet) -> tuple[np.ndarray, np.ndarray]:
    """Word places and key indices of all shingles of the sizes found in ``keys``."""
    places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in sizes:
        at, index = keys.find(shingle_hashes(hashes, size) ^ np.uint64(size))
        places.append(at)
        found.append(index)
    return np.concatenate(places), np.concatenate(found)


def find_windows(hashes: np.ndarray, counts: np.ndarray, index: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every occurrence; ``hashes`` are the words of
    rows one after another, ``counts`` words per row."""
    at, key = _probe(hashes, index.windows.shingle_sizes(), index.keys)
    ends = np.cumsum(counts)
    starts_out, windows_out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = 1 << 18
    fan = index.first[key + 1] - index.first[key]
    inner = np.searchsorted(np.cumsum(fan), np.arange(step, int(fan.sum()), step))
    bounds = np.unique(np.concatenate([[0], inner, [len(at)]]))
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        part = slice(lo, hi)
        which = index.order[starts_to_index(index.first[key[part]], fan[part])]
        start = np.repeat(at[part], fan[part]) - index.offset[which]
        length = index.windows.length[which]
        row = np.searchsorted(ends, np.maximum(start, 0), side="right")
        row = np.minimum(row, len(ends) - 1)
        fits = (start >= 0) & (start + length <= ends[row])
        start, which, length = start[fits], which[fits], length[fits]
        for k in range(index.windows.words.shape[1]):
            if not len(start):
                break
            seen = hashes[np.minimum(start + k, len(hashes) - 1)]
            good = (k >= length) | (seen == index.windows.words[which, k])
            start, which, length = start[good], which[good], length[good]
        starts_out.append(start)
        windows_out.append(which)
    return np.concatenate(starts_out), np.concatenate(windows_out)


def _merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open runs, ascending."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    return s[new], e[np.concatenate([new[1:], [True]])]


def _count_shingles(text: str, keys: KeySet, sizes: list[int]):
    def count(batches):
        total = np.zeros(len(keys.keys), np.int64)
        for batch in batches:
            data, off = flat_text(batch.column(text))
            for i, j in row_pieces(off):
                _, _, hashes, _ = find_words(data[off[i] : off[j]], off[i : j + 1] - off[i])
                _, found = _probe(hashes, sizes, keys)
                total += np.bincount(found, minlength=len(total))
        hit = np.flatnonzero(total)
        if len(hit):
            yield pa.RecordBatch.from_arrays([pa.array(keys.keys[hit].view(np.int64)), pa.array(total[hit])], names=["shingle", "n"])

    return count


OUT = ("n_words", "hit_starts", "hit_ends", "hit_items")
OUT_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_starts", T.ArrayType(T.LongType())),
    T.StructField("hit_ends", T.ArrayType(T.LongType())),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
]


def _mark(text: str, index: Prefixes, again: bool):
    def mark(batches):
        for batch in batches:
            data, off = flat_text(batch.column(text))
            n_words, starts, ends, items = [], [], [], []
            old = [batch.column(c).to_pylist() for c in OUT[1:]] if again else None
            for i, j in row_pieces(off):
                _, _, hashes, counts = find_words(data[off[i] : off[j]], off[i : j + 1] - off[i])
                n_words.append(counts)
                at, which = find_windows(hashes, counts, index)
                tops = np.cumsum(counts) - counts
                row = np.searchsorted(np.cumsum(counts), at, side="right")
                order = np.argsort(row, kind="stable")
                cut = np.searchsorted(row[order], np.arange(len(counts) + 1))
                for r in range(len(counts)):
                    own = order[cut[r] : cut[r + 1]]
                    s = at[own] - tops[r]
                    e = s + index.windows.length[which[own]]
                    ids = {x for w in np.unique(which[own]) for x in index.windows.items[w]}
                    if old:
                        s, e = np.concatenate([s, np.array(old[0][i + r], np.int64)]), np.concatenate([e, np.array(old[1][i + r], np.int64)])
                        ids.update(old[2][i + r])
                    s, e = _merge(s, e)
                    starts.append(s)
                    ends.append(e)
                    items.append(sorted(ids))
            columns = [c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name not in OUT]
            names = [name for name in batch.schema.names if name not in OUT]
            counted = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counted, pa.int64()), pa.array(starts, longs), pa.array(ends, longs), pa.array(items, pa.list_(pa.string()))],
                names=[*names, *OUT],
            )

    return mark


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` plus ``n_words``, the word runs inside any
    occurrence of a window (``hit_starts``, ``hit_ends``: half open) and
    ``hit_items``, the ids (as text, sorted) of the items with occurring
    windows. Columns of these names are replaced."""
    kept = docs.drop(*OUT)
    sc = docs.sparkSession.sparkContext
    # copies of one item are one, so a block's distinct items are all that is collected
    named = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("item_words")).distinct()
    size = named.agg(F.sum(F.octet_length("item_words"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    schema = T.StructType([*kept.schema.fields, *OUT_FIELDS])
    out = kept
    for b in range(blocks):
        own = named.filter(F.pmod(F.xxhash64("id", "item_words"), F.lit(blocks)) == b).collect()
        windows = item_windows([(r["id"], r["item_words"]) for r in own], window)
        keys = KeySet(windows.shingles()[0])
        often = (
            kept.select(text)
            .mapInArrow(_count_shingles(text, keys, windows.shingle_sizes()), "shingle long, n long")
            .groupBy("shingle")
            .agg(F.sum("n").alias("n"))
            .collect()  # at most one row a shingle of the block
        )
        often.sort(key=lambda r: r["shingle"] % (1 << 64))
        index = choose_prefixes(windows, np.array([r["shingle"] for r in often], np.int64).view(np.uint64), np.array([r["n"] for r in often], np.int64))
        shared = sc.broadcast(index)

        def mark(batches, shared=shared, again=b > 0):
            return _mark(text, shared.value, again)(batches)

        out = (written(out, "decontaminate") if b else out).mapInArrow(mark, schema)
    return out
