"""N-gram Jaccard self-join: MinHash LSH forest, then exact verification.

A text is the set of its shingles of five words. Texts with the same set are
one class. Each of ``TREES`` trees gives a class a label: ``DEPTH`` MinHash
values of one byte each, the first the most significant, so that sorted labels
are the tree's prefix trie. A search starts at whole labels and shortens the
matched prefix value by value. At ``matched_depth`` two sets at the threshold
meet in some tree with the ``target`` probability (more similar sets meet more
surely), so no search goes below it. In Spark the leaves of a trie are sorted
within their subtrie of that depth; neighbours there are joined, which makes
the candidate components. A subtrie has at most 256 leaves for each value below
it, however many classes share a leaf: these are joined to the leaf's least class.

A component is cut into blocks of about ``BLOCK_SHINGLES`` shingles and
``BLOCK_ROWS`` classes; each pair of blocks is one tile. A tile verifies the
pairs that meet at whole labels by their exact Jaccard similarity, then those
that a shorter prefix adds, and so on. It stops above ``matched_depth`` only
when the least similar link it has found would already have been met with the
target probability; without a link it never stops early. A tile
returns link counts and a spanning forest, never the pairs themselves, so
a large group costs rows in proportion to its members.

Texts of one to four words have one shingle, all their words. Null texts and
texts without words link to nothing and are classes of their own. Repeated
rows are copies like any others; null ids are kept (a group's id is the
least non-null id in it).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.common import flat_text, row_pieces, written
from clickweir.llm.components import connected_components
from clickweir.llm.words import find_words, mix, row_shingles

SIZE = 5
THRESHOLD = 0.8
TREES = 32
DEPTH = 8  # values of a label, one byte each
TARGET = 0.999
BLOCK_SHINGLES = 1 << 19
BLOCK_ROWS = 1024
PIECE = 1 << 18


def meeting_probability(similarity: float, depth: int, trees: int) -> float:
    return 1 - (1 - similarity**depth) ** trees


def matched_depth(threshold: float, target: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix, shortened from ``depth``, with the target recall."""
    while depth > 1 and meeting_probability(threshold, depth, trees) < target:
        depth -= 1
    if meeting_probability(threshold, depth, trees) < target:
        raise ValueError("the target needs more trees")
    return depth


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of the rows, one after another; per row)."""
    _, _, words, counts = find_words(data, offsets)
    flat, per = row_shingles(words, counts, size)
    ends = np.cumsum(per)
    out = [np.unique(flat[e - n : e]) for e, n in zip(ends.tolist(), per.tolist(), strict=True)]
    sizes = np.array([len(x) for x in out], np.int64)
    return (np.concatenate(out) if out else flat), sizes


def forest_labels(flat: np.ndarray, sizes: np.ndarray, trees: int = TREES, seed: int = 3) -> np.ndarray:
    """(sets, trees): each tree's label, ``DEPTH`` MinHash values of one byte,
    the first on top. Sets must not be empty."""
    rng = np.random.default_rng(seed)
    salt = rng.integers(0, 1 << 63, (trees, DEPTH, 2), dtype=np.int64).astype(np.uint64)
    tops = np.cumsum(sizes) - sizes
    out = np.zeros((len(sizes), trees), np.uint64)
    if not len(sizes):
        return out
    buffer = np.empty_like(flat)
    for t in range(trees):
        for d in range(DEPTH):
            np.bitwise_xor(flat, salt[t, d, 0], out=buffer)
            np.multiply(buffer, salt[t, d, 1] | np.uint64(1), out=buffer)
            value = mix(np.minimum.reduceat(buffer, tops)) >> np.uint64(56)
            out[:, t] = (out[:, t] << np.uint64(8)) | value
    return out


def prefixes(labels: np.ndarray, depth: int) -> np.ndarray:
    return labels.astype(np.uint64, copy=False) >> np.uint64(8 * (DEPTH - depth))


def set_keys(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit key of each (non-empty) set."""
    tops = np.cumsum(sizes) - sizes
    return mix(np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), tops) + sizes.astype(np.uint64)) if len(sizes) else np.zeros(0, np.uint64)


def _signatures(size: int, trees: int):
    def sign(batches):
        for batch in batches:
            data, off = flat_text(batch.column("text"))
            n = batch.num_rows
            cls, sizes_out = np.zeros(n, np.int64), np.zeros(n, np.int64)
            keys = np.zeros((n, trees), np.int64)
            for i, j in row_pieces(off, PIECE):
                flat, sizes = shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i], size)
                some = sizes > 0
                cls[i:j][some] = set_keys(flat, sizes[some]).view(np.int64)
                keys[i:j][some] = forest_labels(flat, sizes[some], trees).view(np.int64)
                sizes_out[i:j] = sizes
            empty = sizes_out == 0
            ends = np.arange(n + 1, dtype=np.int32) * trees
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(cls, mask=empty),
                    pa.array(sizes_out),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()), mask=pa.array(empty)),
                ],
                names=["doc_id", "text_key", "class_key", "n_shingles", "labels"],
            )

    return sign


def _shingle_rows(size: int):
    """Candidate texts as rows of shingles for the tiles."""

    def rows(batches):
        for batch in batches:
            data, off = flat_text(batch.column("text"))
            for i, j in row_pieces(off, PIECE):
                flat, sizes = shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i], size)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                raw = [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("class_key", "copies", "labels", "root", "block", "blocks")), pa.array(raw, pa.binary())],
                    names=["class_key", "copies", "labels", "root", "block", "blocks", "shingles"],
                )

    return rows


def link_rows(keys, copies, labels, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float, shortest: int = DEPTH, target: float = TARGET):
    """Exact links between the ``left`` and ``right`` rows of a tile whose
    labels share a prefix in some tree: (linked copies per row, root row of
    each row's part of the forest). Prefixes are shortened from whole labels
    to ``shortest`` values, or until the links found have the target recall.
    A pair inside both is looked at once."""
    n = len(keys)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    ids = np.unique(flat, return_inverse=True)[1]
    tops = np.cumsum(size) - size
    mark = np.zeros(int(ids.max()) + 1 if len(ids) else 1, bool)
    links, label = np.zeros(n, np.int64), np.arange(n)
    by_size = right[np.argsort(size[right], kind="stable")]
    ordered = size[by_size]
    same = np.array_equal(left, right)
    trees = labels.shape[1] if n else 0
    least, before = 1.0, None  # similarity of the least similar link; the prefixes of the step before
    for depth in range(DEPTH, shortest - 1, -1):
        if least < 1 and meeting_probability(least, depth + 1, trees) >= target:
            break
        now = prefixes(labels, depth)
        for i in left.tolist():
            lo = np.searchsorted(ordered, np.ceil(threshold * size[i] - 1e-9))
            hi = np.searchsorted(ordered, np.floor(size[i] / threshold + 1e-9), side="right")
            near = by_size[lo:hi]
            if same:
                near = near[near > i]
            near = near[(now[near] == now[i]).any(axis=1)]
            if before is not None:
                near = near[~(before[near] == before[i]).any(axis=1)]
            near = near[keys[near] != keys[i]]
            if not len(near):
                continue
            own = ids[tops[i] : tops[i] + size[i]]
            mark[own] = True
            for a in range(0, len(near), 512):
                part = near[a : a + 512]
                spans = size[part]
                starts = np.cumsum(spans) - spans
                at = np.arange(int(spans.sum())) + np.repeat(tops[part] - starts, spans)
                shared = np.add.reduceat(mark[ids[at]], starts, dtype=np.int64)
                union = size[i] + spans - shared
                # shared / union >= threshold, kept in whole thousandths
                good = 1000 * shared >= round(1000 * threshold) * union
                hit = part[good]
                if len(hit):
                    least = min(least, float((shared[good] / union[good]).min()))
                    links[i] += copies[hit].sum()
                    links[hit] += copies[i]
                    joined = np.unique(label[np.append(hit, i)])
                    if len(joined) > 1:
                        label[np.isin(label, joined)] = joined[0]
            mark[own] = False
        before = now
    return links, label


def _tiles(threshold: float, shortest: int, target: float):
    def emit(group: list[dict]):
        first = {}
        for r in group:
            first.setdefault((r["class_key"], r["block"]), r)  # a repeated row is one class
        rows = sorted(first.values(), key=lambda r: (r["block"], r["class_key"]))
        keys = np.array([r["class_key"] for r in rows])
        block = np.array([r["block"] for r in rows])
        a, b = rows[0]["tile_a"], rows[0]["tile_b"]
        links, label = link_rows(
            keys, np.array([r["copies"] for r in rows]), np.array([r["labels"] for r in rows], np.int64),
            [np.frombuffer(r["shingles"], np.uint64) for r in rows], np.flatnonzero(block == a), np.flatnonzero(block == b), threshold, shortest, target,
        )
        hit = np.flatnonzero(links)
        if len(hit):
            yield pa.RecordBatch.from_arrays([pa.array(keys[hit]), pa.array(links[hit]), pa.array(keys[label[hit]])], names=["class_key", "links", "tree_root"])

    def run(batches):
        held, key = [], None
        for batch in batches:
            for r in batch.to_pylist():
                now = (r["root"], r["tile_a"], r["tile_b"])
                if now != key and held:
                    yield from emit(held)
                    held = []
                key = now
                held.append(r)
        if held:
            yield from emit(held)

    return run


def jaccard_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SIZE, threshold: float = THRESHOLD, target: float = TARGET, trees: int = TREES, block_shingles: int = BLOCK_SHINGLES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row a document: ``doc_id``, ``text_key`` (xxhash64 of the text),
    ``class_id`` (least id of the documents connected by links), ``kept``
    (this row's id and text are the ones to keep of its group), ``alone`` (no
    words) and ``n_links`` (other documents at or above the threshold)."""
    depth = matched_depth(threshold, target, trees)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    rows = written(
        source.mapInArrow(_signatures(size, trees), f"doc_id {id_type}, text_key long, class_key long, n_shingles long, labels array<long>"), "join-rows"
    )
    # ids sort before the lack of one
    who = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_key"))
    classes = written(
        rows.filter("class_key IS NOT NULL")
        .groupBy("class_key")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(who).alias("who"), F.first("n_shingles").alias("n_shingles"), F.first("labels").alias("labels")),
        "join-classes",
    )
    nodes = classes.select("class_key", F.posexplode("labels").alias("tree", "label"))
    leaves = nodes.groupBy("tree", "label").agg(F.count(F.lit(1)).alias("n"), F.min("class_key").alias("least"))
    # the sorted leaves below a prefix: at most 256 for each value they have beyond it
    below = Window.partitionBy("tree", F.shiftrightunsigned("label", 8 * (DEPTH - depth))).orderBy("label")
    met_leaves = written(leaves.withColumn("other", F.lag("least").over(below)).filter("n > 1 OR other IS NOT NULL"), "join-leaves")
    on_leaf = nodes.join(met_leaves.filter("n > 1"), ["tree", "label"]).select("class_key", "least")
    beside = met_leaves.filter("other IS NOT NULL").select("least", "other")
    met = connected_components(on_leaf.union(beside))
    members = written(met.join(classes, F.col("node") == F.col("class_key")).drop("node"), "join-members")
    weight = members.groupBy("root").agg(F.ceil(F.greatest(F.sum("n_shingles") / block_shingles, F.count(F.lit(1)) / block_rows)).cast("int").alias("blocks"))
    placed = members.join(weight, "root").withColumn("block", F.pmod(F.xxhash64("class_key"), F.col("blocks")).cast("int"))
    # one text stands for its class: the row with the least id
    texts = (
        source.join(
            placed.select("class_key", "copies", "labels", "root", "block", "blocks", F.col("who.doc_id").alias("own_id"), F.col("who.text_key").alias("own_key")),
            F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key")),
        )
        .select("text", "class_key", "copies", "labels", "root", "block", "blocks")
        .mapInArrow(_shingle_rows(size), "class_key long, copies long, labels array<long>, root long, block int, blocks int, shingles binary")
    )
    tiles = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("block", "other").alias("tile_a"), F.greatest("block", "other").alias("tile_b"), "class_key", "block", "copies", "labels", "shingles"
    )
    links = written(
        tiles.repartition("root", "tile_a", "tile_b")
        .sortWithinPartitions("root", "tile_a", "tile_b")
        .mapInArrow(_tiles(threshold, depth, target), "class_key long, links long, tree_root long"),
        "join-links",
    )
    groups = connected_components(links.select("class_key", "tree_root"))
    named = classes.join(groups, F.col("class_key") == F.col("node"), "left").select("class_key", "copies", "who", F.coalesce("root", "class_key").alias("root"))
    least = named.groupBy("root").agg(F.min("who").alias("first"))
    counted = links.groupBy("class_key").agg(F.sum("links").alias("links"))
    verdict = named.join(least, "root").join(counted, "class_key", "left").select("class_key", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    alone = F.col("first").isNull()
    return (
        rows.select("doc_id", "text_key", "class_key")
        .join(verdict, "class_key", "left")
        .select(
            "doc_id",
            "text_key",
            F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
            (alone | (F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_key") == F.col("text_key")))).alias("kept"),
            alone.alias("alone"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        )
    )
