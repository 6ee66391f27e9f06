"""Exact substring dedup: suffix arrays over anchored contexts.

Every string of ``length`` bytes that occurs twice must be found, but a
suffix array over all documents fits no task. So each string is assigned
to an anchor: its ``GRAM``-byte substring with the least hash (the leftmost of
equals). Equal strings have equal anchors. Consecutive strings with
the same anchor occurrence form one context, and contexts meet by anchor hash:

* an anchor seen once cannot be part of a repeat;
* contexts equal to another one are repeats from end to end;
* the distinct contexts of an anchor are concatenated, with those of other
  anchors, into blocks of about ``BLOCK`` bytes. Each block gets a two-stage
  suffix array and adjacent common prefixes; a string is a repeat where its
  common prefix with a neighbour in the order reaches ``length``.

An anchor with more than ``HOT`` distinct contexts is split, exactly: its
contexts are cut into cells of fewer start places, which meet by the bytes
all strings of the cell share; cells still too many are cut again, down to
one start place, where equal content decides.

Texts are bytes (null: empty); strings never cross documents. Repeated rows
are occurrences of their own. Rows with equal text get equal results, so
null and repeated ids need no care. Texts shorter than ``length`` keep all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.llm.common import flat_text, starts_to_index, written
from clickweir.llm.suffix_sort import adjacent_common, suffix_order
from clickweir.llm.words import BASE, mix, powers

LENGTH = 400
GRAM = 50
BLOCK = 1 << 19
HOT = 700
CELLS = (96, 24, 6, 1)  # start places a cell, step by step
PLACE_BITS = np.uint64(21)
PIECE = 1 << 19  # bytes routed at once: their hashes and places take some twenty times as much
DOWN = np.uint64(pow(int(BASE), -1, 1 << 64))


class Prefixes:
    """Hashes of any substring of a byte array."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.down = np.full(n + 1, DOWN, np.uint64)
        self.down[0] = 1
        np.cumprod(self.down, out=self.down)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(n + 1)[:n], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def find_anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Contexts of the rows of a flat byte array: (row, first and last start
    place within ``data``, anchor place, anchor hash, context hash)."""
    n, window = len(data), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    sums = Prefixes(data)
    places = np.arange(n - gram + 1)
    grams = sums.of(places, places + gram)
    packed = (grams >> PLACE_BITS << PLACE_BITS) | places.astype(np.uint64)
    wide = np.full(-(-len(packed) // window) * window, np.uint64(0xFFFFFFFFFFFFFFFF))
    wide[: len(packed)] = packed
    wide = wide.reshape(-1, window)
    ahead = np.minimum.accumulate(wide, axis=1).ravel()
    behind = np.minimum.accumulate(wide[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1
    least = np.minimum(behind[:starts], ahead[window - 1 : window - 1 + starts])
    anchor = (least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[:starts] == row[length - 1 :]
    first = inside.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1] | (row[1:starts] != row[: starts - 1])
    last = inside.copy()
    last[:-1] &= first[1:] | ~inside[1:]
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    at = anchor[a]
    context = mix(sums.of(a, b + length) ^ ((at - a).astype(np.uint64) << np.uint64(32)) ^ (b - a).astype(np.uint64))
    return row[a], a, b, at, grams[at], context


def repeat_runs(row: np.ndarray, first: np.ndarray, last: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of equal contexts that follow one another in a row, as periodic
    text has them: (index of each run's first, contexts in the run)."""
    again = np.zeros(len(row), bool)
    again[1:] = (row[1:] == row[:-1]) & (content[1:] == content[:-1]) & (first[1:] == last[:-1] + 1)
    head = np.flatnonzero(~again)
    return head, np.diff(np.append(head, len(row)))


def _pieces(offsets: np.ndarray, length: int, limit: int = PIECE):
    """(first row, rows, first byte, last byte): runs of whole rows, or
    overlapping cuts of one long row."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        if j > i:
            yield i, j, int(offsets[i]), int(offsets[j])
            i = j
            continue
        at = int(offsets[i])
        while True:
            end = min(at + limit, int(offsets[i + 1]))
            yield i, i + 1, at, end
            if end == offsets[i + 1]:
                break
            at = end - length + 1
        i += 1


ANCHORS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("anchor", "context", "key_a", "key_b")]
    # a run of equal contexts is one row: the first one's start and the last one's
    + [T.StructField("start", T.LongType()), T.StructField("reach", T.LongType()), T.StructField("times", T.LongType())]
    + [T.StructField("starts", T.IntegerType()), T.StructField("lead", T.IntegerType())]
)


def _anchor_rows(length: int, gram: int):
    def rows(batches):
        for batch in batches:
            data, off = flat_text(batch.column("text"))
            keys = [batch.column(k).to_numpy() for k in ("key_a", "key_b")]
            for i, j, lo, hi in _pieces(off, length):
                bounds = np.clip(off[i : j + 1], lo, hi) - lo
                row, a, b, at, anchor, context = find_anchors(data[lo:hi], bounds, length, gram)
                head, times = repeat_runs(row, a, b, context)
                reach = a[head + times - 1]
                row, a, b, at, anchor, context = (x[head] for x in (row, a, b, at, anchor, context))
                begin = off[i + row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), pa.array(keys[0][i + row]), pa.array(keys[1][i + row]),
                        pa.array(a + lo - begin), pa.array(reach + lo - begin), pa.array(times), pa.array((b - a + 1).astype(np.int32)), pa.array((at - a).astype(np.int32)),
                    ],
                    names=ANCHORS.names,
                )

    return rows


CELL = "grp long, full long, anchor long, context long, low int, high int, lead int, distinct long, raw binary"
CELL_NAMES = [c.split()[0] for c in CELL.split(", ")]
CELL_TYPES = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]] for c in CELL.split(", ")]
RUN = "anchor long, context long, low int, high int"


def _cells(rows: list[tuple]):
    for at in range(0, len(rows), 1024):
        cols = zip(*rows[at : at + 1024], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, CELL_TYPES, strict=True)], names=CELL_NAMES)


def _cut_contexts(length: int):
    """Bytes of the wanted contexts of each text. Places count from the
    context's first start."""

    def rows(batches):
        for batch in batches:
            for text, contexts in zip(batch.column("raw_text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                yield from _cells(
                    [
                        (c["anchor"], c["context"], c["anchor"], c["context"], 0, c["starts"] - 1, c["lead"], c["distinct"], text[c["start"] : c["start"] + c["starts"] - 1 + length])
                        for c in contexts
                    ]
                )

    return rows


def split_cell(raw: np.ndarray, anchor: int, low: int, high: int, lead: int, width: int, length: int):
    """Cut a cell at a grid of start places counted from the anchor: (keys,
    content keys, first and last places). The key is the hash of what every
    string that starts in the grid cell shares; any string of the cell
    holds those bytes whole, wherever its context is cut."""
    sums = Prefixes(raw)
    grid = np.arange((low - lead) // width, (high - lead) // width + 1) * width
    begin = grid + lead  # the grid cell's own first place
    lows, highs = np.maximum(begin, low), np.minimum(begin + width - 1, high)
    core = sums.of(begin + width - 1 - low, begin + length - low)
    key = mix(core ^ np.int64(anchor).astype(np.uint64) ^ (grid.astype(np.uint64) * BASE))
    shape = ((lows - begin).astype(np.uint64) << np.uint64(32)) ^ (highs - lows).astype(np.uint64)
    full = mix(sums.of(lows - low, highs - low + length) ^ shape ^ key)
    return key, full, lows, highs


def _split(width: int, length: int):
    def rows(batches):
        for batch in batches:
            for r in batch.to_pylist():
                raw = np.frombuffer(r["raw"], np.uint8)
                key, full, lows, highs = split_cell(raw, r["anchor"], r["low"], r["high"], r["lead"], width, length)
                yield from _cells(
                    [
                        (k, f, r["anchor"], r["context"], a, b, r["lead"], 0, r["raw"][a - r["low"] : b - r["low"] + length])
                        for k, f, a, b in zip(key.view(np.int64).tolist(), full.view(np.int64).tolist(), lows.tolist(), highs.tolist(), strict=True)
                    ]
                )

    return rows


def repeats_in(raws: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """Runs (cell, first, last place) of the strings of ``length`` bytes in
    the cells that occur at least twice among them, by suffix array."""
    sizes = np.array([len(r) for r in raws])
    data = np.frombuffer(b"".join(raws), np.uint8)
    tops = np.cumsum(sizes) - sizes
    valid = np.zeros(len(data), bool)
    valid[starts_to_index(tops, np.maximum(sizes - length + 1, 0))] = True
    order = suffix_order(data, length)
    common = adjacent_common(data, order, length)
    # suffixes that agree for the whole length stand together, those that
    # run over the end of their cell among them
    run = np.cumsum(common < length)
    members = np.bincount(run, valid[order], int(run[-1]) + 1 if len(run) else 0)
    twice = np.zeros(len(data), bool)
    twice[order] = members[run] >= 2
    twice &= valid
    edge = np.flatnonzero(np.diff(np.concatenate([[0], twice.view(np.int8), [0]])))
    out = []
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        cell = int(np.searchsorted(tops, a, side="right")) - 1
        # the last places of a cell are not valid, so a run stays in its cell
        out.append((cell, a - int(tops[cell]), b - 1 - int(tops[cell])))
    return out


def _repeats(length: int, block: int):
    def resolve(cells: list[dict]):
        found = repeats_in([c["raw"] for c in cells], length)
        if found:
            own = [cells[c] for c, _, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c["anchor"] for c in own], pa.int64()),
                    pa.array([c["context"] for c in own], pa.int64()),
                    pa.array([c["low"] + a for c, (_, a, _) in zip(own, found, strict=True)], pa.int32()),
                    pa.array([c["low"] + b for c, (_, _, b) in zip(own, found, strict=True)], pa.int32()),
                ],
                names=["anchor", "context", "low", "high"],
            )

    def run(batches):
        held, size, group, seen = [], 0, None, set()
        for batch in batches:
            for r in batch.to_pylist():
                if r["grp"] != group:
                    if size >= block:
                        yield from resolve(held)
                        held, size = [], 0
                    group, seen = r["grp"], set()
                if r["full"] in seen:
                    continue  # the same cell again, from a repeated row
                seen.add(r["full"])
                held.append(r)
                size += len(r["raw"])
        if held:
            yield from resolve(held)

    return run


def repeated_runs(cells: DataFrame, length: int, hot: int, block: int) -> list[DataFrame]:
    """Runs of repeats inside groups of cells. ``cells``: one a group and
    content, with the number of ``distinct`` ones in its group."""

    def by_suffixes(rows: DataFrame) -> DataFrame:
        return rows.repartition("grp").sortWithinPartitions("grp").mapInArrow(_repeats(length, block), RUN)

    out = [by_suffixes(cells.filter(F.col("distinct") <= hot))]
    large = cells.filter(F.col("distinct") > hot)
    for width in CELLS:
        if width >= length or large.isEmpty():
            continue
        split = written(large.mapInArrow(_split(width, length), CELL).drop("distinct"), "dedup-split")
        alike = split.groupBy("grp", "full").agg(F.countDistinct("anchor", "context").alias("n"), F.min("context").alias("one"))
        groups = alike.groupBy("grp").agg(F.count(F.lit(1)).alias("distinct"))
        marked = written(split.join(alike, ["grp", "full"]).join(groups, "grp"), "dedup-marked")
        out.append(marked.filter("n > 1").select("anchor", "context", "low", "high"))
        # one of each content goes on, as a partner for the others
        first = marked.filter("context = one AND distinct > 1").select(*CELL_NAMES)
        out.append(by_suffixes(first.filter(F.col("distinct") <= hot)))
        large = first.filter(F.col("distinct") > hot)
    return out


def text_keys(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("key_a"), F.xxhash64(F.lit(7), text).alias("key_b")


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(key_a, key_b, spans): for each text with repeats, by its ``text_keys``,
    the start and end of every run of repeated strings, as an array of
    (start, stop) in bytes; runs may overlap."""
    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text")).filter(F.octet_length("text") >= length).select("doc_id", "text", *text_keys(F.col("text")))
    anchors = written(source.select("text", "key_a", "key_b").mapInArrow(_anchor_rows(length, gram), ANCHORS), "dedup-anchors")
    seen = anchors.groupBy("anchor").agg(F.sum("times").alias("n")).filter("n > 1").select("anchor")
    shared = written(anchors.join(seen, "anchor"), "dedup-shared")
    where = F.struct("key_a", "key_b", "start")
    contexts = written(
        shared.groupBy("anchor", "context", "starts", "lead").agg(F.sum("times").alias("n"), F.min(where).alias("at")), "dedup-contexts"
    )
    kinds = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("distinct")).filter("distinct > 1")
    own = contexts.join(kinds, "anchor")
    wanted = own.select(F.col("at.key_a").alias("key_a"), F.col("at.key_b").alias("key_b"), F.struct("anchor", "context", "at.start", "starts", "lead", "distinct").alias("c"))
    wanted = wanted.groupBy("key_a", "key_b").agg(F.collect_list("c").alias("wanted"))  # as many as the text has anchors
    # one row stands for equal texts
    owner = source.groupBy("key_a", "key_b").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"))).alias("who"))
    wanted = wanted.join(owner, ["key_a", "key_b"]).withColumn("own_id", F.col("who.doc_id")).drop("who")
    right = wanted.select(F.col("key_a").alias("own_a"), F.col("key_b").alias("own_b"), "own_id", "wanted")
    texts = source.join(right, (F.col("key_a") == F.col("own_a")) & (F.col("key_b") == F.col("own_b")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
    cells = written(texts.select(F.col("text").cast("binary").alias("raw_text"), "wanted").mapInArrow(_cut_contexts(length), CELL), "dedup-cells")
    runs = contexts.filter("n > 1").select("anchor", "context", F.lit(0).alias("low"), (F.col("starts") - 1).alias("high"))
    for found in repeated_runs(cells, length, hot, block):
        runs = runs.unionByName(found)
    spans = (
        shared.join(written(runs, "dedup-runs"), ["anchor", "context"])
        # a run of equal contexts repeats from end to end
        .select("key_a", "key_b", (F.col("start") + F.col("low")).alias("start"), (F.col("reach") + F.col("high") + length).alias("stop"))
        .distinct()
    )
    return spans.groupBy("key_a", "key_b").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open runs; runs that touch become one."""
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(stops[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    return s[new], e[np.concatenate([new[1:], [True]])]


OUT = ("kept_bytes", "removed", "kept_text")


def _remove(text: str):
    def run(batches):
        for batch in batches:
            kept, removed, texts = [], [], []
            for raw, spans in zip(batch.column("raw_text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if not spans:
                    kept.append(raw)
                    removed.append([])
                    texts.append(None)
                    continue
                s, e = merged(np.array([x["start"] for x in spans]), np.array([x["stop"] for x in spans]))
                edges = [0, *np.stack([s, e], axis=1).ravel().tolist(), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                removed.append([{"start": a, "stop": b} for a, b in zip(s.tolist(), e.tolist(), strict=True)])
                texts.append(kept[-1].decode("utf-8", "ignore"))
            names = [n for n in batch.schema.names if n not in ("raw_text", "spans")]
            pair = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(kept, pa.binary()), pa.array(removed, pa.list_(pair)), pa.array(texts, pa.string())], names=[*names, *OUT]
            )

    return run


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """All columns of ``docs`` plus ``kept_bytes`` (what is left of the text),
    ``removed`` (maximal removed runs of bytes) and, where something was removed,
    ``kept_text`` (the whole characters left). Columns of these names are replaced."""
    kept = docs.drop(*OUT)
    spans = repeated_spans(kept, text, doc_id, length, gram, hot, block).select(F.col("key_a").alias("span_a"), F.col("key_b").alias("span_b"), "spans")
    body = F.coalesce(F.col(text), F.lit(""))
    a, b = (c for c in text_keys(body))
    columns = [F.col(f"d.`{c}`") for c in kept.columns]
    keyed = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("d"), a, b, body.cast("binary").alias("raw_text"))
    joined = keyed.join(spans, (F.col("key_a") == F.col("span_a")) & (F.col("key_b") == F.col("span_b")), "left")
    pair = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    shape = T.StructType([joined.schema["d"], T.StructField("kept_bytes", T.BinaryType()), T.StructField("removed", T.ArrayType(pair)), T.StructField("kept_text", T.StringType())])
    return joined.select("d", "raw_text", "spans").mapInArrow(_remove(text), shape).select(*columns, *OUT)
