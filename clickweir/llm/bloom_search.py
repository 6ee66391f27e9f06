"""Ranked lexical search over bit-sliced Bloom signatures.

``sign_texts`` gives every text a Bloom signature of its terms, as wide as their
number asks for. Texts of one width stand side by side in a block, stored by
slices: one bitmap over the block's texts for each signature bit. A term that occurs 2, 4,
8 ... times is also entered under those powers, so the slices bound its frequency from above.

A search of a set of items goes in blocks of items:

* one pass counts in how many documents each of their terms occurs;
* the slices of a term are joined by AND, which gives all documents that hold it
  and a few that do not; the weighted sums over an item's terms are upper bounds
  of the scores of all documents;
* the documents with the highest bounds are scored exactly, which gives each item a score that
  its last place must reach;
* every document whose bound reaches it is scored exactly. The others are
  provably below.

Terms are compared by 64-bit hashes. Null texts and texts without terms are no
documents; items without terms find nothing. Documents of equal text have one
bound and rank by id, null ids last; repeated rows are ranked as rows of their own, and
repeated items each get the whole result. Only an item block's terms, counts
and thresholds pass through the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.common import flat_text, row_pieces, written
from clickweir.llm.suffix_dedup import text_keys
from clickweir.llm.words import find_words, mix

PLACES = 10
FIRST = 20  # documents an item that are scored to find its threshold
HASHES = 4
BITS_A_KEY = 14  # with 4 hashes a slice is a quarter full
POWERS = 8
PIECE = 1 << 22
ITEM_BLOCK = 1 << 20
CELLS = 1 << 22  # of a table terms x texts held at once
BROADCAST_BYTES = 64 << 20
SALT = 0x9FB21C651E98DF25
# Fixed values of the score: scale, share of the length in it, saturation.
UNIT, SCALE, LENGTH_SHARE, SATURATION = 1_000_000_000, 1000, 90, 8


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash and frequency of each distinct term of a row, terms with repeats per row)."""
    _, _, hashes, per_row = find_words(data, offsets)
    row = np.repeat(np.arange(len(per_row)), per_row)
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    head = np.ones(len(row), bool)
    head[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(head)
    return row[at], hashes[at], np.diff(np.append(at, len(row))), per_row


def width_for(keys: np.ndarray) -> np.ndarray:
    """Slices for so many keys: the next number 2^k or 3 * 2^(k-1)."""
    need = np.maximum(keys * BITS_A_KEY, 64)
    power = np.int64(1) << np.ceil(np.log2(need)).astype(np.int64)
    return np.where(power // 4 * 3 >= need, power // 4 * 3, power)


def slice_places(terms: np.ndarray, power: int, width: int) -> np.ndarray:
    """(terms, HASHES): the slices of a term at a power of its frequency."""
    key = mix(terms ^ np.uint64((power + 1) * SALT & 0xFFFFFFFFFFFFFFFF))
    step = (key >> np.uint64(32)) | np.uint64(1)
    return ((key[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(width)).astype(np.int64)


def signature_blocks(row: np.ndarray, terms: np.ndarray, tf: np.ndarray, n_rows: int):
    """(width, rows, slices of ``rows`` bits packed to bytes) per width."""
    power = np.minimum(np.log2(tf).astype(np.int64), POWERS - 1)
    keys = np.bincount(row, power + 1, n_rows).astype(np.int64)
    widths = np.where(keys > 0, width_for(keys), 0)
    for width in np.unique(widths[widths > 0]).tolist():
        rows = np.flatnonzero(widths == width)
        column = np.full(n_rows, -1)
        column[rows] = np.arange(len(rows))
        wide = -(-len(rows) // 8)
        slices = np.zeros(width * wide, np.uint8)
        own = column[row] >= 0
        for p in range(POWERS):
            entered = own & (power >= p)
            if not entered.any():
                break
            at = column[row[entered]]
            bit = (128 >> (at % 8)).astype(np.uint8)
            places = slice_places(terms[entered], p, width) * wide + (at // 8)[:, None]
            np.bitwise_or.at(slices, places.ravel(), np.repeat(bit, HASHES))
        yield width, rows, slices


SIGNED = "width int, n_docs long, n_terms long, slices binary, key_a array<long>, key_b array<long>, lengths array<long>, most array<long>"
SIGNED_NAMES = [c.split()[0] for c in SIGNED.split(", ")]


def _sign(batches):
    for batch in batches:
        data, off = flat_text(batch.column("text"))
        keys = [batch.column(k).to_numpy() for k in ("key_a", "key_b")]
        for i, j in row_pieces(off, PIECE):
            row, terms, tf, lengths = term_counts(data[off[i] : off[j]], off[i : j + 1] - off[i])
            most = np.zeros(j - i, np.int64)
            np.maximum.at(most, row, tf)
            for width, rows, slices in signature_blocks(row, terms, tf, j - i):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([width], pa.int32()), pa.array([len(rows)], pa.int64()), pa.array([int(lengths[rows].sum())], pa.int64()), pa.array([slices.tobytes()], pa.binary()),
                        *(pa.array([x], pa.list_(pa.int64())) for x in (keys[0][i:j][rows], keys[1][i:j][rows], lengths[rows], most[rows])),
                    ],
                    names=SIGNED_NAMES,
                )


def sign_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The index: a table of signature blocks over all texts with terms."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return written(docs.select(body.alias("text"), *text_keys(body)).mapInArrow(_sign, SIGNED), "search-index")


@dataclass
class ItemBlock:
    """Items of a block: their terms as numbers into the sorted ``terms``."""

    terms: np.ndarray
    per_item: list[np.ndarray]
    weights: np.ndarray | None = None  # of the terms
    documents: int = 0
    words: int = 0

    def spread(self, lengths: np.ndarray) -> np.ndarray:
        """A document's length against the mean one, in hundredths, with a floor."""
        return np.array([100 - LENGTH_SHARE + LENGTH_SHARE * n * self.documents // self.words for n in lengths.tolist()], np.int64)


def part_scores(tf: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return UNIT * tf // (SCALE * tf + SATURATION * spread)


def upper_bounds(items: ItemBlock, width: int, slices: np.ndarray, lengths: np.ndarray, most: np.ndarray):
    """(first text, bounds as items x texts) of parts of a signature block."""
    wide = -(-len(lengths) // 8)
    slices = slices.reshape(width, wide)
    spread = items.spread(lengths)
    powers = min(POWERS, int(most.max()).bit_length())
    places = [slice_places(items.terms, p, width) for p in range(powers)]
    step = max(1, CELLS // max(1, 8 * len(items.terms)))
    for at in range(0, wide, step):
        cut = slice(8 * at, min(8 * (at + step), len(lengths)))
        own = np.ascontiguousarray(slices[:, at : at + step])
        values = np.zeros((len(items.terms), cut.stop - cut.start))
        below, held = 0, None
        for p in range(powers):
            found = np.bitwise_and.reduce(own[places[p]], axis=1)
            held = found if held is None else held & found
            if not held.any():
                break
            limit = most[cut] if p == POWERS - 1 else np.minimum((2 << p) - 1, most[cut])
            value = part_scores(limit, spread[cut])
            values += np.unpackbits(held, axis=1, count=values.shape[1]) * (value - below).astype(np.float64)
            below = value
        values *= items.weights[:, None]
        yield cut.start, np.stack([values[t].sum(axis=0) for t in items.per_item])


def _bounded(items: ItemBlock, batches):
    """(key_a, key_b, bounds) of parts of all signature blocks."""
    for batch in batches:
        for k in range(batch.num_rows):
            arrays = [batch.column(n)[k].values.to_numpy() for n in ("key_a", "key_b", "lengths", "most")]
            slices = np.frombuffer(batch.column("slices")[k].as_buffer(), np.uint8)
            for first, bounds in upper_bounds(items, batch.column("width")[k].as_py(), slices, *arrays[2:]):
                end = first + bounds.shape[1]
                yield arrays[0][first:end], arrays[1][first:end], bounds


def _highest(items, count: int):
    """Each task's documents with the highest bounds for each item."""

    def run(batches):
        best = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items.value.per_item)
        for key_a, key_b, bounds in _bounded(items.value, batches):
            for i, row in enumerate(bounds):
                old = best[i]
                floor = old[0].min() if len(old[0]) >= count else 0
                new = np.flatnonzero(row > floor)
                if len(new):
                    joined = [np.concatenate(x) for x in zip(old, (row[new], key_a[new], key_b[new]), strict=True)]
                    keep = np.lexsort((joined[2], joined[1], -joined[0]))
                    again = np.zeros(len(keep), bool)  # equal texts are one
                    again[1:] = (joined[1][keep[1:]] == joined[1][keep[:-1]]) & (joined[2][keep[1:]] == joined[2][keep[:-1]])
                    best[i] = tuple(x[keep[~again][:count]] for x in joined)
        n = [len(b[0]) for b in best]
        if sum(n):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(n)), n).astype(np.int32)), *(pa.array(np.concatenate([b[k] for b in best])) for k in (1, 2, 0))],
                names=["item", "key_a", "key_b", "bound"],
            )

    return run


def _not_excluded(items, least):
    """Documents whose bounds reach some items' thresholds, with those items."""

    def run(batches):
        for key_a, key_b, bounds in _bounded(items.value, batches):
            reach = bounds >= least.value[:, None]
            some = np.flatnonzero(reach.any(axis=0))
            if len(some):
                text, item = np.nonzero(reach[:, some].T)
                ends = np.searchsorted(text, np.arange(len(some) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key_a[some]), pa.array(key_b[some]), pa.ListArray.from_arrays(pa.array(ends), pa.array(item.astype(np.int32)))], names=["key_a", "key_b", "items"]
                )

    return run


def _known(terms: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which hashes are among the sorted terms, their numbers)."""
    at = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
    known = terms[at] == hashes if len(terms) else np.zeros(len(hashes), bool)
    return known, at[known]


def _holders(terms):
    """Documents that hold each term, per task."""

    def run(batches):
        n = np.zeros(len(terms.value), np.int64)
        for batch in batches:
            data, off = flat_text(batch.column("text"))
            for i, j in row_pieces(off, PIECE):
                _, hashes, _, _ = term_counts(data[off[i] : off[j]], off[i : j + 1] - off[i])
                n += np.bincount(_known(terms.value, hashes)[1], minlength=len(n))
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(n[hit])], names=["term", "n"])

    return run


def _scores(items):
    """Exact scores of the wanted items for each document."""

    def run(batches):
        block = items.value
        for batch in batches:
            data, off = flat_text(batch.column("text"))
            wanted = batch.column("items")
            for i, j in row_pieces(off, PIECE):
                row, hashes, tf, lengths = term_counts(data[off[i] : off[j]], off[i : j + 1] - off[i])
                known, term = _known(block.terms, hashes)
                row, tf = row[known], tf[known]
                part = part_scores(tf, block.spread(lengths)[row]) * block.weights[term].astype(np.int64)
                starts = np.searchsorted(row, np.arange(j - i + 1))
                out_row, out_item, out_score = [], [], []
                own = np.zeros(len(block.terms), np.int64)
                for r in range(j - i):
                    a, b = starts[r], starts[r + 1]
                    own[term[a:b]] = part[a:b]
                    for item in wanted[i + r].values.to_pylist():
                        score = int(own[block.per_item[item]].sum())
                        if score > 0:
                            out_row.append(i + r)
                            out_item.append(item)
                            out_score.append(score)
                    own[term[a:b]] = 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(out_row, pa.int64())), pa.array(out_item, pa.int32()), pa.array(out_score, pa.int64())], names=["doc_id", "item", "score"]
                )

    return run


def _exact(texts: DataFrame, wanted: DataFrame, items) -> DataFrame:
    """(doc_id, item, score above 0) of the documents of ``wanted``: each
    distinct text with its array of items. The wanted side is
    broadcast only while it is small by its own count."""
    size = wanted.agg(F.count(F.lit(1)), F.sum(F.size("items"))).first()
    if 48 * size[0] + 4 * (size[1] or 0) <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.join(wanted, ["key_a", "key_b"]).select("doc_id", "text", "items").mapInArrow(_scores(items), f"doc_id {id_type}, item int, score long")


def _ranked(scores: DataFrame, places: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= places)


def _item_block(rows: list, documents: int, words: int) -> ItemBlock:
    body = [(r["text"] or "").encode() for r in rows]
    off = np.concatenate([[0], np.cumsum([len(b) for b in body])]).astype(np.int64)
    row, hashes, _, _ = term_counts(np.frombuffer(b"".join(body), np.uint8), off)
    terms, number = np.unique(hashes, return_inverse=True)
    ends = np.searchsorted(row, np.arange(len(rows) + 1))
    return ItemBlock(terms, [number[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], None, documents, words)


def _search_block(texts: DataFrame, index: DataFrame, block: ItemBlock, places: int) -> DataFrame:
    sc = texts.sparkSession.sparkContext
    terms = sc.broadcast(block.terms)
    holders = texts.select("text").mapInArrow(_holders(terms), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(len(block.terms), np.int64)
    for r in holders:
        df[r["term"]] = r["n"]
    block.weights = np.array([math.floor(SCALE * math.log((2 * block.documents + 2) / (2 * n + 1))) for n in df.tolist()], np.float64)
    items = sc.broadcast(block)
    best = Window.partitionBy("item").orderBy(F.desc("bound"), "key_a", "key_b")
    high = index.mapInArrow(_highest(items, FIRST), "item int, key_a long, key_b long, bound double").distinct().withColumn("at", F.row_number().over(best)).filter(F.col("at") <= FIRST)
    first = written(high.groupBy("key_a", "key_b").agg(F.collect_list("item").alias("items")), "search-first")
    last = _ranked(_exact(texts, first, items), places).filter(F.col("rank") == places).select("item", "score").collect()
    least = np.ones(len(block.per_item))
    for r in last:
        least[r["item"]] = r["score"]
    left = index.mapInArrow(_not_excluded(items, sc.broadcast(least)), "key_a long, key_b long, items array<int>")
    wanted = written(left.groupBy("key_a", "key_b").agg(F.first("items").alias("items")), "search-wanted")  # equal texts have equal bounds
    return _ranked(_exact(texts, wanted, items), places)


def search(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id", places: int = PLACES, item_block: int = ITEM_BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``places`` documents with the highest
    scores above 0 for each item, by score and ascending id."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("text"), *text_keys(body))
    index = sign_texts(docs, text)
    total = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"), *text_keys(F.coalesce(F.col(f"`{item_text}`"), F.lit(""))))
    kinds = written(asked.dropna(subset=["text"]).groupBy("key_a", "key_b").agg(F.first("text").alias("text")), "search-items")
    size = kinds.agg(F.sum(F.octet_length("text"))).first()[0]
    found = None
    blocks = -(-(size or 0) // item_block) if total["n"] else 0
    for b in range(blocks):
        rows = kinds.filter(F.pmod("key_a", F.lit(blocks)) == b).collect()  # about item_block bytes of distinct texts
        if not rows:
            continue
        ranked = _search_block(texts, index, _item_block(rows, total["n"], total["l"]), places)
        names = docs.sparkSession.createDataFrame([(i, r["key_a"], r["key_b"]) for i, r in enumerate(rows)], "item int, key_a long, key_b long")
        part = ranked.join(F.broadcast(names), "item").select("key_a", "key_b", "rank", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = texts.select("key_a", "key_b", F.lit(1).alias("rank"), "doc_id", F.lit(0).cast("long").alias("score")).limit(0)
    return asked.select("item_id", "key_a", "key_b").join(written(found, "search-found"), ["key_a", "key_b"]).select("item_id", "rank", "doc_id", "score")
