"""Approximate nearest neighbours by inner product: inverted lists with an
adaptive dimension scan.

A bounded sample fits the list centres; every vector is put
into the list of its nearest centre. How many lists are probed is measured: for up to
``ASKED`` of the queries the truly nearest of all rows are found by brute force, and the
probes are the fewest whose recall on them reaches ``target``. Lists grow in number with the table, one for
``BLOCK`` vectors, up to one for eight vectors of the sample, which ``sample_rows``
bounds. Lists are cut into blocks of about ``BLOCK`` vectors, so a list that
holds a third of all vectors is many blocks. Query blocks are joined to the blocks of the lists they probe. In a
block, directions are randomly rotated and scanned by blocks of columns. After
each one a hypothesis test drops the candidates whose distance in direction, as the
columns so far suggest, is too large for the query's bound: the k-th best inner product
so far, at first among the sample. (The test is about the difference of the two, which a
random rotation spreads evenly over the columns however alike they are.) Survivors get
their exact inner product in double precision on the original vectors.

Vectors that are null, zero, of another length than most, or that hold null or
non-finite components take no part, nor do rows with a null id. A repeated
id stands for one vector, its smallest. Fewer than ``k`` candidates: all of
them. No vectors, or no queries: no rows. Ties go to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.common import unit_hash, written

LISTS = 64  # at least
BLOCK = 1536
QUERY_BLOCK = 256
SAMPLE_ROWS = 8192
SAMPLE_CELLS = 1 << 22
TARGET = 0.96
COLUMNS = 16
HITS = "query_id long, ids array<long>, scores array<double>"
ERROR = 3.5  # standard deviations a dropped candidate falls short by
ROUNDING = 1e-9  # of inner products of unit vectors
ASKED = 256  # queries whose true neighbours tell how many lists to probe


@dataclass
class Lists:
    centres: np.ndarray  # (lists, dims), unit length
    probes: int
    rotation: np.ndarray  # (dims, dims), orthogonal
    sample: np.ndarray  # (rows, dims)
    sample_ids: np.ndarray


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def lists_for(rows: int) -> int:
    """Lists that a table of so many vectors asks for."""
    return max(LISTS, rows // BLOCK)


def fit_lists(ids: np.ndarray, vectors: np.ndarray, k: int, n_lists: int = LISTS, target: float = TARGET, seed: int = 11) -> Lists:
    """Spherical k-means on the sample, and the probes its recall asks for."""
    rng = np.random.default_rng(seed)
    dims = vectors.shape[1]
    directions = unit(vectors)
    n_lists = max(1, min(n_lists, len(np.unique(directions, axis=0)), len(vectors) // 8))
    centres = directions[rng.choice(len(vectors), n_lists, replace=False)].copy()
    for _ in range(8):
        near = (directions @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, near, directions)
        used = np.linalg.norm(total, axis=1) > 0
        centres[used] = unit(total[used])
    rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    asked = rng.choice(len(vectors), min(256, len(vectors)), replace=False)
    scores = vectors[asked] @ vectors.T
    scores[np.arange(len(asked)), asked] = -np.inf
    top = np.argsort(-scores, axis=1, kind="stable")[:, : max(1, min(k, len(vectors) - 1))]
    near = (directions @ centres.T).argmax(axis=1)
    order = np.argsort(-(vectors[asked] @ centres.T), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n_lists)[None, :], axis=1)
    place = np.take_along_axis(rank, near[top], axis=1)  # how many lists until a neighbour's
    recall = np.array([(place < p).mean() for p in range(1, n_lists + 1)])
    probes = int(np.argmax(recall >= target)) + 1 if (recall >= target).any() else n_lists
    return Lists(centres, probes, rotation, vectors, ids)


def usable_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v): one valid vector an id, all of the commonest length."""
    v = F.col(vector).cast("array<double>")
    picked = rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    one = picked.filter(finite & some).groupBy("vec_id").agg(F.min("v").alias("v"))
    table = written(one, "ann-vectors")
    sizes = table.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    return table.filter(F.size("v") == (sizes[0]["dims"] if sizes else 0))


def matrix_of(col: pa.Array) -> np.ndarray:
    n = len(col)
    flat = np.asarray(col.flatten(), dtype=np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 1))


def _groups(batches, keys: tuple[str, ...], limit: int):
    """Runs of rows with equal ``keys`` (rows come sorted by them), across
    batch bounds, cut at ``limit`` rows."""
    held: list[pa.RecordBatch] = []

    def flush():
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        return table

    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if held and [held[-1].column(k)[-1].as_py() for k in keys] != key[a].tolist():
                yield flush()
            held.append(batch.slice(a, b - a))
            if sum(h.num_rows for h in held) >= limit:
                yield flush()
    if held:
        yield flush()


def _assign(shared):
    def assign(batches):
        lists = shared.value
        for batch in batches:
            x = matrix_of(batch.column("v"))
            near = (x @ lists.centres.T).argmax(axis=1) if len(x) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(near, pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())], names=["vec_id", "list", "raw"]
            )

    return assign


def _pack(batches):
    for group in _groups(batches, ("list", "block"), 1 << 30):
        ids = group["vec_id"].to_numpy()
        order = np.argsort(ids)
        raw = group["raw"].to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([group["list"][0].as_py()], pa.int32()),
                pa.array([group["block"][0].as_py()], pa.int32()),
                pa.array([ids[order].tobytes()], pa.binary()),
                pa.array([b"".join(raw[i] for i in order)], pa.binary()),
            ],
            names=["list", "block", "ids", "vectors"],
        )


def _sample_hits(shared, k: int):
    """The best of the sample for each query: rows found like any others,
    so that the bound they give never leaves a query with fewer than it can have."""

    def hits(batches):
        lists = shared.value
        dims = lists.centres.shape[1]
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            for a in range(0, len(ids), QUERY_BLOCK):
                own = ids[a : a + QUERY_BLOCK]
                x = np.frombuffer(b"".join(batch.column("raw")[a : a + QUERY_BLOCK].to_pylist())).reshape(-1, dims)
                seen = x @ lists.sample.T
                seen[own[:, None] == lists.sample_ids[None, :]] = -np.inf
                top = np.argsort(-seen, axis=1, kind="stable")[:, :k]
                top = [t[np.isfinite(seen[r, t])] for r, t in enumerate(top)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own, pa.int64()),
                        pa.array([lists.sample_ids[t] for t in top], pa.list_(pa.int64())),
                        pa.array([(lists.sample[t] * x[r]).sum(axis=1) for r, t in enumerate(top)], pa.list_(pa.float64())),
                    ],
                    names=["query_id", "ids", "scores"],
                )

    return hits


def _ask(shared, k: int):
    """A block of queries: for each list, the queries that probe it, with
    the bound the sample gives them."""

    def ask(batches):
        lists = shared.value
        dims = lists.centres.shape[1]
        for group in _groups(batches, ("query_block",), QUERY_BLOCK):
            ids = group["vec_id"].to_numpy()
            x = np.frombuffer(b"".join(group["raw"].to_pylist())).reshape(-1, dims)
            seen = x @ lists.sample.T
            seen[ids[:, None] == lists.sample_ids[None, :]] = -np.inf
            bound = np.full(len(ids), -np.inf)
            if seen.shape[1] >= k:
                bound = -np.partition(-seen, k - 1, axis=1)[:, k - 1]
            order = np.argsort(-(x @ lists.centres.T), axis=1, kind="stable")[:, : lists.probes]
            for one in np.unique(order):
                q = np.flatnonzero((order == one).any(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([one], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in (ids[q], x[q], bound[q]))],
                    names=["list", "query_ids", "query_vectors", "bounds"],
                )

    return ask


def scan_block(q_ids, q, bound, ids, x, rotation, k: int):
    """The ``k`` best of a block for each query: (query row, ids, scores).
    ``ids`` are ascending, so stable sorting breaks ties as wanted."""
    dims = q.shape[1]
    x_norm, q_norm = (np.maximum(np.linalg.norm(m, axis=1), 1e-300) for m in (x, q))
    xr, qr = (x / x_norm[:, None]) @ rotation, (q / q_norm[:, None]) @ rotation
    edges = [*range(0, dims, COLUMNS), dims]
    x_seen, q_seen = np.cumsum(xr**2, axis=1), np.cumsum(qr**2, axis=1)
    first = qr[:, : edges[1]] @ xr[:, : edges[1]].T
    for i in range(len(q)):
        live, part, low = np.arange(len(x)), first[i], bound[i]
        if low == -np.inf and len(x) > k:
            # the block's own k-th best among the most promising bounds the rest
            head = np.argpartition(-part * x_norm, k)[: 2 * k]
            low = np.sort(x[head[ids[head] != q_ids[i]]] @ q[i])[::-1][k - 1 : k]
            low = low[0] if len(low) else -np.inf
        # the cosine a candidate needs; beyond 1 it cannot reach the bound
        need = low / (q_norm[i] * x_norm) - ROUNDING
        for a, b in zip(edges[1:], [*edges[2:], None], strict=True):
            if b is None:
                break
            apart = q_seen[i, a - 1] + x_seen[live, a - 1] - 2 * part
            spread = np.sqrt((dims - a) / (2 * a * (dims + 2)))  # of its root, relative
            keep = apart <= min(1.0, a / dims * (1 + ERROR * spread) ** 2) * (2 - 2 * need[live]) + ROUNDING
            live, part = live[keep], part[keep]
            if not len(live):
                break
            part = part + xr[live, a:b] @ qr[i, a:b]
        live = live[part >= need[live]]
        live = live[ids[live] != q_ids[i]]
        if not len(live):
            continue
        exact = (x[live] * q[i]).sum(axis=1)
        best = np.argsort(-exact, kind="stable")[:k]
        yield i, ids[live[best]], exact[best]


def _scan(shared, k: int, kept_queries: int = 50_000):
    def batch_of(best):
        if best:
            keys = list(best)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([best[q][0] for q in keys], pa.list_(pa.int64())), pa.array([best[q][1] for q in keys], pa.list_(pa.float64()))],
                names=["query_id", "ids", "scores"],
            )

    def scan(batches):
        rotation = shared.value.rotation
        dims = len(rotation)
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for raw_q, raw_x, raw_bound, raw_ids, raw_v in zip(*(batch.column(c).to_pylist() for c in ("query_ids", "query_vectors", "bounds", "ids", "vectors")), strict=True):
                q_ids, bound = np.frombuffer(raw_q, np.int64), np.frombuffer(raw_bound).copy()
                for r, one in enumerate(q_ids.tolist()):
                    if one in best and len(best[one][0]) >= k:
                        bound[r] = max(bound[r], best[one][1][-1])
                q, x = np.frombuffer(raw_x).reshape(-1, dims), np.frombuffer(raw_v).reshape(-1, dims)
                for i, ids, scores in scan_block(q_ids, q, bound, np.frombuffer(raw_ids, np.int64), x, rotation, k):
                    one = int(q_ids[i])
                    if one in best:
                        ids, scores = np.concatenate([best[one][0], ids]), np.concatenate([best[one][1], scores])
                        order = np.lexsort((ids, -scores))[:k]
                        ids, scores = ids[order], scores[order]
                    best[one] = (ids, scores)
                if len(best) > kept_queries:
                    yield from batch_of(best)
                    best.clear()
        yield from batch_of(best)

    return scan


def _true_hits(shared, k: int):
    """The ``k`` best of a task's vectors for each asked query, and their lists."""

    def hits(batches):
        ids, vectors = shared.value
        dims = vectors.shape[1]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0))] * len(ids)
        for batch in batches:
            if not batch.num_rows:
                continue
            own, lists = batch.column("vec_id").to_numpy(), batch.column("list").to_numpy()
            x = np.frombuffer(b"".join(batch.column("raw").to_pylist())).reshape(-1, dims)
            scores = vectors @ x.T
            scores[ids[:, None] == own[None, :]] = -np.inf
            top = np.argpartition(-scores, k - 1, axis=1)[:, :k] if len(own) > k else np.broadcast_to(np.arange(len(own)), (len(ids), len(own)))
            for q, t in enumerate(top):
                t = t[scores[q, t] > -np.inf]
                both = [np.concatenate(pair) for pair in zip(found[q], (own[t], lists[t], scores[q, t]), strict=True)]
                best = np.lexsort((both[0], -both[2]))[:k]
                found[q] = tuple(c[best] for c in both)
        if any(len(f[0]) for f in found):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, [len(f[0]) for f in found])), *(pa.array(np.concatenate(c)) for c in zip(*found, strict=True))],
                names=["query_id", "vec_id", "list", "score"],
            )

    return hits


def probes_needed(asked: np.ndarray, found: list[np.ndarray], centres: np.ndarray, target: float) -> int:
    """The fewest lists to probe for a mean recall of ``target``, and for one of 0.9
    in nine of ten queries. ``found``: the lists of each query's true neighbours."""
    order = np.argsort(-(asked @ centres.T), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(len(centres))[None, :], axis=1)
    places = [rank[q, lists] for q, lists in enumerate(found)]
    for probes in range(1, len(centres)):
        recall = np.array([(p < probes).mean() if len(p) else 1.0 for p in places])
        if recall.mean() >= target and (recall >= 0.9).mean() >= 0.9:
            return probes
    return len(centres)


def measured_probes(placed: DataFrame, queries: DataFrame, n_queries: int, lists: Lists, k: int, target: float) -> int:
    """``probes_needed`` by at most some ``ASKED`` queries against all rows: one pass
    over the vectors, whose result is ``k`` rows a query."""
    drawn = queries.filter(unit_hash(F.lit(3), "vec_id") < ASKED / n_queries).select("vec_id", "raw").collect() or queries.select("vec_id", "raw").limit(1).collect()
    ids = np.array([r["vec_id"] for r in drawn], np.int64)
    vectors = np.frombuffer(b"".join(bytes(r["raw"]) for r in drawn)).reshape(len(ids), -1)
    shared = placed.sparkSession.sparkContext.broadcast((ids, vectors))
    hits = placed.mapInArrow(_true_hits(shared, k), "query_id long, vec_id long, list int, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    nearest_lists = {i: [] for i in ids.tolist()}
    for r in hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "list").collect():
        nearest_lists[r["query_id"]].append(r["list"])
    return probes_needed(vectors, [np.array(nearest_lists[i], int) for i in ids.tolist()], lists.centres, target)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", n_lists: int | None = None, target: float = TARGET, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row
    for which ``is_query`` (over ``vec_id``) holds, its own row left out.
    ``n_lists``: as many as the table asks for (None), or that many at most."""
    spark = rows.sparkSession
    vectors = usable_vectors(rows, vec_id, vector)
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not shape["n"]:
        return empty
    wanted = max(1, min(sample_rows, SAMPLE_CELLS // shape["dims"]))
    drawn = vectors.filter(unit_hash("vec_id") < wanted / shape["n"]).collect() or vectors.limit(1).collect()
    drawn.sort(key=lambda r: r["vec_id"])
    n_lists = n_lists or lists_for(shape["n"])
    lists = fit_lists(np.array([r["vec_id"] for r in drawn], np.int64), np.array([r["v"] for r in drawn], float), k, n_lists, target)
    shared = spark.sparkContext.broadcast(lists)  # bounded by the sample
    placed = written(vectors.mapInArrow(_assign(shared), "vec_id long, list int, raw binary"), "ann-lists")
    queries = placed.filter(is_query)
    n_queries = queries.count()
    if not n_queries:
        return empty
    lists.probes = measured_probes(placed, queries, n_queries, lists, k, target)
    shared = spark.sparkContext.broadcast(lists)
    sizes = {r["list"]: r["n"] for r in placed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a list
    blocks = F.element_at(F.array(*[F.lit(-(-sizes.get(i, 1) // BLOCK)) for i in range(len(lists.centres))]), F.col("list") + 1)
    total = sum(-(-n // BLOCK) for n in sizes.values())
    index = (
        placed.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks).cast("int"))
        .repartition(max(1, total // 4), "list", "block")
        .sortWithinPartitions("list", "block")
        .mapInArrow(_pack, "list int, block int, ids binary, vectors binary")
    )
    asked = (
        queries.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, n_queries // QUERY_BLOCK))).cast("int"))
        .repartition(max(1, n_queries // (4 * QUERY_BLOCK)), "query_block")
        .sortWithinPartitions("query_block")
        .mapInArrow(_ask(shared, k), "list int, query_ids binary, query_vectors binary, bounds binary")
        .withColumn("block", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
    )
    found = (
        asked.join(index, ["list", "block"])
        .select("query_ids", "query_vectors", "bounds", "ids", "vectors")
        .mapInArrow(_scan(shared, k), HITS)
        .unionByName(queries.select("vec_id", "raw").mapInArrow(_sample_hits(shared, k), HITS))
        .select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("hit"))
        .groupBy("query_id", F.col("hit.ids").alias("vec_id"))
        .agg(F.max("hit.scores").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
