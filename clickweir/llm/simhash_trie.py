"""SimHash near-dedup: self-join of a binary trie of fingerprints.

A fingerprint sums up the shingles of a text: bit i is 1 if it is set in
over half of their XXH64 hashes. Texts link where their fingerprints differ in
``BUDGET`` bits at most, and linked texts form components.

Equal fingerprints are one. The distinct ones are a binary trie, whose levels
are the bits from the highest on. The join walks pairs of nodes from the root: a
pair's children are paired, the bits in which they differ add up, and a pair
over the budget goes with everything below it. The upper levels are
Spark joins of node tables, ``STEP`` bits at a time, until the two nodes of a pair hold
``BLOCK`` fingerprints at most; such a pair is one unit. Inside a unit numpy
walks on, bit by bit, all node pairs of a level together, and compares the
fingerprints of small ones. A unit returns a spanning forest of its links,
never the links, so a dense group costs rows in proportion to its members.

Null texts and texts without words have the fingerprint zero, which links like any
other; with fewer words than a shingle the whole sequence is the one shingle.
Repeated rows are copies. A null id names no component: its row gets the
least non-null id reachable, or null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.llm.common import flat_text, written
from clickweir.llm.components import connected_components

SIZE = 4
SEED = 42
BUDGET = 4
BITS = 64
STEP = 4
BLOCK = 1 << 15
LEAF = 16  # pairs of fingerprints that are compared without walking on
FRONTIER = 1 << 17
HASHES = 1 << 16


def fingerprint(raw: bytes, size: int = SIZE, seed: int = SEED) -> int:
    """Of one text: A-Z lower-cased, words without ASCII white space."""
    words = raw.lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    begin, stop = starts[: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(begin), HASHES):
        part = [digest(joined[a:b], seed) for a, b in zip(begin[at : at + HASHES], stop[at : at + HASHES], strict=True)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(begin), bitorder="little").view("<u8")[0])


def _fingerprints(size: int, seed: int):
    def rows(batches):
        for batch in batches:
            data, off = flat_text(batch.column("raw_text"))
            own = np.array([fingerprint(data[a:b].tobytes(), size, seed) for a, b in zip(off[:-1], off[1:], strict=True)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own.view(np.int64))], names=["doc_id", "print"])

    return rows


class Node:
    """The sorted fingerprints below a trie node, with the number of zeros
    at each bit before each place."""

    def __init__(self, prints: np.ndarray):
        self.prints = np.sort(prints)
        self._zeros: dict[int, np.ndarray] = {}

    def split(self, level: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Where the one side of each range [low, high) begins; the ranges
        agree in all bits above the level's."""
        if level not in self._zeros:
            bit = (self.prints >> np.uint64(BITS - 1 - level)) & np.uint64(1)
            self._zeros[level] = np.concatenate([[0], np.cumsum(bit == 0, dtype=np.int32)])
        zeros = self._zeros[level]
        return low + zeros[high] - zeros[low]


def linked_pairs(a: Node, b: Node, level: int, differing: int, budget: int):
    """Places (i in a, j in b) of all pairs within the budget, in parts. The
    nodes' prefixes of ``level`` bits differ in ``differing`` ones. With ``a``
    and ``b`` the same node, each pair comes once."""
    same = a is b
    one = np.array([0])
    stack = [(level, one, one + len(a.prints), one, one + len(b.prints), one + differing)]
    while stack:
        level, a_low, a_high, b_low, b_high, bits = stack.pop()
        if len(bits) > FRONTIER:
            half = len(bits) // 2
            rest = (a_low, a_high, b_low, b_high, bits)
            stack += [(level, *(x[half:] for x in rest)), (level, *(x[:half] for x in rest))]
            continue
        small = ((a_high - a_low) * (b_high - b_low) <= LEAF) | (level == BITS)
        if small.any():
            yield from _compared(a, b, a_low[small], a_high[small], b_low[small], b_high[small], budget, same)
            a_low, a_high, b_low, b_high, bits = (x[~small] for x in (a_low, a_high, b_low, b_high, bits))
        if not len(bits):
            continue
        a_mid, b_mid = a.split(level, a_low, a_high), b.split(level, b_low, b_high)
        sides = []
        for a_from, a_to, left in ((a_low, a_mid, 0), (a_mid, a_high, 1)):
            for b_from, b_to, right in ((b_low, b_mid, 0), (b_mid, b_high, 1)):
                now = bits + (left ^ right)
                go = (now <= budget) & (a_from < a_to) & (b_from < b_to)
                if same and left > right:
                    go &= a_low != b_low  # a node with itself: its mirrored children are there already
                sides.append([x[go] for x in (a_from, a_to, b_from, b_to, now)])
        stack.append((level + 1, *(np.concatenate(x) for x in zip(*sides, strict=True))))


def _compared(a: Node, b: Node, a_low, a_high, b_low, b_high, budget: int, same: bool):
    """Exact distances of all pairs of the given small node pairs."""
    wide = b_high - b_low
    total = (a_high - a_low) * wide
    cut = np.cumsum(total)
    at = 0
    while at < len(total):  # a pair that is not small stands for one fingerprint each, or for the last level
        end = max(at + 1, int(np.searchsorted(cut, (cut[at - 1] if at else 0) + 8 * FRONTIER, side="right")))
        n = total[at:end]
        which = np.repeat(np.arange(at, end), n)
        k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        i, j = a_low[which] + k // wide[which], b_low[which] + k % wide[which]
        if same:
            once = i < j
            i, j = i[once], j[once]
        near = np.bitwise_count(a.prints[i] ^ b.prints[j]) <= budget
        if near.any():
            yield i[near], j[near]
        at = end


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give the nodes i and j, pair by pair, one label, the least, in place.
    Labels are nodes; a root is its own."""
    while True:
        p, q = label[i], label[j]
        apart = p != q
        if not apart.any():
            return
        i, j, p, q = i[apart], j[apart], p[apart], q[apart]
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def unit_forest(left: np.ndarray, right: np.ndarray | None, level: int, differing: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, the one it hangs on) of a spanning forest of the links
    between two nodes, or inside one (``right`` None)."""
    a = Node(left)
    b = a if right is None else Node(right)
    shift = 0 if right is None else len(a.prints)
    prints = a.prints if right is None else np.concatenate([a.prints, b.prints])
    label = np.arange(len(prints))
    for i, j in linked_pairs(a, b, level, differing, budget):
        unite(label, i, j + shift)
    child = np.flatnonzero(label != np.arange(len(label)))
    return prints[child], prints[label[child]]


def _units(budget: int):
    def forest(key, sides):
        depth, a, b, bits = key
        nodes = {node: np.array(prints, np.int64).view(np.uint64) for node, prints in sides}
        return unit_forest(nodes[a], None if a == b else nodes[b], depth, bits, budget)

    def run(batches):
        key, sides = None, []
        for batch in batches:
            column = batch.column("prints")
            heads = [batch.column(n).to_pylist() for n in ("depth", "a", "b", "bits", "node")]
            for k, (*now, node) in enumerate(zip(*heads, strict=True)):
                if now != key:
                    if sides:
                        yield edges(*forest(key, sides))
                    key, sides = now, []
                sides.append((node, column[k].values.to_numpy()))
        if sides:
            yield edges(*forest(key, sides))

    def edges(child, root):
        return pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(root.view(np.int64))], names=["a", "b"])

    return run


def _prefix(column: str, depth: int):
    """The highest ``depth`` bits (a shift by 64 would be one by none)."""
    return F.shiftrightunsigned(column, BITS - depth) if depth else F.lit(0).cast("long")


def node_pairs(prints: DataFrame, budget: int, block: int) -> DataFrame:
    """Units: (depth, a, b, bits) of node pairs within the budget that hold
    ``block`` fingerprints at most, found from the root down. A pair that is
    too large is replaced by the pairs of its nodes' descendants, ``STEP`` bits below."""
    spark = prints.sparkSession
    units = None
    n = prints.count()
    now = spark.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0).alias("bits"))
    depth = 0
    while True:
        if depth == 0:
            sized = now.withColumn("held", F.lit(n).cast("long"))
        else:
            nodes = written(prints.groupBy(_prefix("print", depth).alias("node")).agg(F.count(F.lit(1)).alias("n")), "trie-nodes")
            parent = F.shiftrightunsigned("node", STEP)
            own = nodes.select(parent.alias("a"), F.col("node").alias("a_node"), F.col("n").alias("a_n"))
            other = nodes.select(parent.alias("b"), F.col("node").alias("b_node"), F.col("n").alias("b_n"))
            apart = F.bit_count(F.col("a_node").bitwiseXOR(F.col("b_node")).bitwiseAND(F.lit((1 << STEP) - 1).cast("long")))
            sized = (
                now.join(own, "a").join(other, "b")
                .filter((F.col("a") != F.col("b")) | (F.col("a_node") <= F.col("b_node")))
                .select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), (F.col("bits") + apart).alias("bits"), (F.col("a_n") + F.col("b_n")).alias("held"))
                .filter(F.col("bits") <= budget)
            )
        sized = written(sized, "trie-pairs")
        done = (F.col("held") <= block) | F.lit(depth + STEP >= BITS)
        ready = sized.filter(done).select(F.lit(depth).alias("depth"), "a", "b", "bits")
        units = ready if units is None else units.unionByName(ready)
        now = sized.filter(~done).select("a", "b", "bits")
        if now.isEmpty():
            return units
        depth += STEP


def print_links(prints: DataFrame, budget: int = BUDGET, block: int = BLOCK) -> DataFrame:
    """(a, b): a spanning forest of the links among distinct fingerprints
    (column ``print``), with repeats among the units' parts of it."""
    units = written(node_pairs(prints, budget, block), "trie-units")
    sides = units.select("*", F.explode(F.array_distinct(F.array("a", "b"))).alias("node"))
    depths = [r["depth"] for r in units.select("depth").distinct().collect()]  # 16 at most
    packed = None
    for depth in depths:
        # no node of a unit holds more than a block, or has more than the last bits to tell apart
        wanted = sides.filter(F.col("depth") == depth)
        nodes = prints.select(_prefix("print", depth).alias("node"), "print").join(wanted.select("node").distinct(), "node", "left_semi")
        rows = wanted.join(nodes.groupBy("node").agg(F.collect_list("print").alias("prints")), "node")
        packed = rows if packed is None else packed.unionByName(rows)
    if packed is None:
        return prints.select(F.col("print").alias("a"), F.col("print").alias("b")).limit(0)
    key = ("depth", "a", "b")
    return packed.select("depth", "a", "b", "bits", "node", "prints").repartition(*key).sortWithinPartitions(*key).mapInArrow(_units(budget), "a long, b long")


def simhash_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SIZE, budget: int = BUDGET, block: int = BLOCK) -> DataFrame:
    """One row a document: ``doc_id``, ``fingerprint`` (the 64 bits as a long)
    and ``component_id`` (the least id of its component)."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("raw_text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    rows = written(source.mapInArrow(_fingerprints(size, SEED), f"doc_id {id_type}, print long"), "simhash-rows")
    prints = written(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-prints")
    links = written(print_links(prints.select("print"), budget, block), "simhash-links")
    groups = connected_components(links)
    rooted = prints.join(groups, F.col("print") == F.col("node"), "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("print", "component_id")
    return rows.join(named, "print").select("doc_id", F.col("print").alias("fingerprint"), "component_id")
