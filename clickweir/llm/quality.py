"""Quality classifier: a byte-level convolutional network in numpy.

Each byte becomes a short fixed descriptor (character class, low bits, and
how recently the same four bytes occurred). Learned filters of eight bytes,
moved four bytes at a time, run over overlapping chunks that cover the
whole document; each filter is max-pooled within a chunk, the chunk vectors
are averaged by length, and a small dense layer gives one probability.

Training uses a bounded sample of the labelled rows (``sample_rows`` per
class) and all chunks of them, a slice of a batch at a time; scoring reads
every byte. Null and empty texts have no chunk: their pooled vector is zero and
they get the score the dense layer gives for it. Rows are scored one by one, so
repeated rows and null ids are kept; only ``text`` is an input.
"""

from __future__ import annotations

import tempfile
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.llm.common import flat_text, starts_to_index, unit_hash, written

GROUP = 4  # bytes a filter advances by; a filter spans two groups
CHUNK_GROUPS = 128
CHUNK_BYTES = GROUP * CHUNK_GROUPS
SCORED = 256  # chunks scored at a time
FILTERS = 32
HIDDEN = 16
RECENT = 64
SAMPLE_ROWS = 1000
SLICE = 1024  # chunks of a training batch at a time
STEPS = 640
BATCH = 32


def _byte_table() -> np.ndarray:
    b = np.arange(256)
    lower, upper = (b >= 97) & (b <= 122), (b >= 65) & (b <= 90)
    digit, space, high = (b >= 48) & (b <= 57), np.isin(b, (9, 10, 13, 32)), b >= 128
    punct = ~(lower | upper | digit | space | high)
    bits = [((b >> k) & 1) * 0.5 for k in range(5)]
    return np.stack([lower, upper, digit, space, high, punct, *bits], axis=1).astype(np.float32)


BYTES = _byte_table()
WIDTH = BYTES.shape[1] + 1


@dataclass
class Network:
    left: np.ndarray  # filters on the first group
    right: np.ndarray  # filters on the second group
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    out: np.ndarray
    out_bias: float


def untrained() -> Network:
    """A network that gives every text 0.5."""
    span = GROUP * WIDTH
    shapes = ((span, FILTERS), (span, FILTERS), FILTERS, (FILTERS + 1, HIDDEN), HIDDEN, HIDDEN)
    return Network(*(np.zeros(s, np.float32) for s in shapes), 0.0)


def recency(data: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """1 where the four bytes occurred just before, falling to 0 at
    ``RECENT`` bytes back; ``first``, ``stop``: bounds of each byte's own segment,
    which the four bytes do not leave."""
    out = np.zeros(len(data), np.float32)
    if len(data) < 5:
        return out
    word = data[:-3].astype(np.uint32)
    for k in (1, 2, 3):
        word |= data[k : len(data) - 3 + k].astype(np.uint32) << np.uint32(8 * k)
    key = ((word * np.uint32(2654435761)) >> np.uint32(16)).astype(np.uint16)
    order = np.argsort(key, kind="stable")
    before = np.full(len(key), -(1 << 40), np.int64)
    same = key[order[1:]] == key[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    at = np.arange(len(key))
    gap = at - before
    seen = (gap < RECENT) & (before >= first[: len(key)]) & (at + 3 < stop[: len(key)])
    out[: len(key)][seen] = 1 - gap[seen] / RECENT
    return out


def descriptors(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group descriptors of consecutive segments, each padded to whole
    groups and followed by one empty group; and groups per segment."""
    groups = -(-lengths // GROUP) + 1
    ends = np.cumsum(lengths)
    first, stop = np.repeat(ends - lengths, lengths), np.repeat(ends, lengths)
    padded = np.zeros((int(groups.sum()) * GROUP, WIDTH), np.float32)
    at = starts_to_index((np.cumsum(groups) - groups) * GROUP, lengths)
    padded[at, :-1] = BYTES[data]
    padded[at, -1] = recency(data, first, stop) * 2
    return padded.reshape(-1, GROUP * WIDTH), groups


def chunk_peaks(data: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, bias: np.ndarray):
    """Filters over chunks, each followed by the group after it (if any), so that
    filters cross its end: (descriptors, groups per chunk, responses, maxima per
    chunk, groups of the chunk itself). Training and scoring both use it."""
    x, groups = descriptors(data, sizes)
    z = x @ left
    z[:-1] += x[1:] @ right
    z += bias
    np.maximum(z, 0, out=z)
    ends = np.cumsum(groups)
    share = np.minimum(groups - 1, CHUNK_GROUPS)
    # neither the empty group nor the one after the chunk has a window here
    z[ends - 1] = 0
    z[(ends - 2)[groups - 1 > CHUNK_GROUPS]] = 0
    peak = np.maximum.reduceat(z, ends - groups, axis=0) if len(groups) else np.zeros((0, FILTERS), np.float32)
    return x, groups, z, peak, share


def _head(pooled: np.ndarray, net: Network) -> np.ndarray:
    hidden = np.tanh(pooled @ net.dense + net.dense_bias)
    return hidden @ net.out + net.out_bias


def score_bytes(data: np.ndarray, offsets: np.ndarray, net: Network) -> np.ndarray:
    """Probability per row of a flat byte array. A row's score depends on its
    own bytes only."""
    lengths = np.diff(offsets)
    n = -(-lengths // CHUNK_BYTES)
    ends = np.cumsum(n)
    total = np.zeros((len(lengths), FILTERS), np.float64)
    weight = np.zeros(len(lengths), np.float64)
    for done in range(0, int(n.sum()), SCORED):
        chunk = np.arange(done, min(done + SCORED, int(n.sum())))
        rows = np.searchsorted(ends, chunk, side="right")
        starts = (chunk - (ends - n)[rows]) * CHUNK_BYTES
        size = np.minimum(CHUNK_BYTES + GROUP, lengths[rows] - starts)
        part = data[starts_to_index(offsets[rows] + starts, size)]
        _, _, _, peak, share = chunk_peaks(part, size, net.left, net.right, net.bias)
        np.add.at(total, rows, peak * share[:, None])
        np.add.at(weight, rows, share)
    mean = (total / np.maximum(weight, 1)[:, None]).astype(np.float32)
    pooled = np.concatenate([mean, np.log1p(lengths)[:, None].astype(np.float32) / 10], axis=1)
    return 1 / (1 + np.exp(-np.clip(_head(pooled, net), -30, 30).astype(np.float64)))


def train(chunks: np.ndarray, sizes: np.ndarray, owner: np.ndarray, n_bytes: np.ndarray, labels: np.ndarray, shift: float, place: np.ndarray, seed: int = 7) -> Network:
    """Adam on the cross-entropy. Chunk k: the first ``sizes[k]`` bytes of
    ``chunks[place[k]]`` (which may be a file); ``owner``: sorted row of each chunk;
    ``shift``: log odds from the sample's class balance to the population's."""
    rng = np.random.default_rng(seed)
    span = GROUP * WIDTH
    p = [
        rng.normal(0, 0.25, (span, FILTERS)), rng.normal(0, 0.25, (span, FILTERS)), np.zeros(FILTERS),
        rng.normal(0, 0.3, (FILTERS + 1, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1),
    ]
    p = [a.astype(np.float32) for a in p]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    span_of = np.arange(chunks.shape[1])[None, :]

    def forward(c: np.ndarray):
        return chunk_peaks(chunks[place[c]][span_of < sizes[c][:, None]], sizes[c], *p[:3])

    first_chunk = np.searchsorted(owner, np.arange(len(labels) + 1))
    step = 0
    while step < STEPS:
        order = rng.permutation(len(labels))
        for i in range(0, len(order), BATCH):
            docs = np.sort(order[i : i + BATCH])
            counts = np.diff(first_chunk)[docs]
            own = np.repeat(np.arange(len(docs)), counts)
            picked = starts_to_index(first_chunk[docs], counts)
            share = np.minimum(-(-sizes[picked] // GROUP), CHUNK_GROUPS).astype(np.float32)
            weight = np.maximum(np.bincount(own, share, len(docs)), 1).astype(np.float32)
            share = (share / weight[own])[:, None]
            mean = np.zeros((len(docs), FILTERS), np.float32)
            # descriptors are many times the bytes: those of a slice at a time
            slices = [slice(k, k + SLICE) for k in range(0, len(picked), SLICE)]
            for part in slices:
                held = forward(picked[part])
                np.add.at(mean, own[part], held[3] * share[part])
            pooled = np.concatenate([mean, np.log1p(n_bytes[docs])[:, None].astype(np.float32) / 10], axis=1)
            hidden = np.tanh(pooled @ p[3] + p[4])
            prob = 1 / (1 + np.exp(-np.clip(hidden @ p[5] + p[6][0], -30, 30)))
            err = ((prob - labels[docs]) / len(docs)).astype(np.float32)
            back = np.outer(err, p[5]) * (1 - hidden**2)
            grads = [None, None, None, pooled.T @ back, back.sum(0), hidden.T @ err, np.array([err.sum()], np.float32)]
            d_mean = (back @ p[3].T)[:, :FILTERS]
            sel = np.zeros((FILTERS, span), np.float32)
            sel2 = np.zeros((FILTERS, span), np.float32)
            bias = np.zeros(FILTERS, np.float32)
            for part in slices:
                xb, g, z, peak, _ = held if len(slices) == 1 else forward(picked[part])
                d_peak = d_mean[own[part]] * share[part]
                # the gradient reaches only the window that won each pool
                hit = z == np.repeat(peak, g, axis=0)
                hit &= z > 0
                where_row, where_filter = np.nonzero(hit)
                chunk_of = np.repeat(np.arange(len(g)), g)[where_row]
                key = chunk_of * FILTERS + where_filter
                _, once = np.unique(key, return_index=True)
                where_row, where_filter, chunk_of = where_row[once], where_filter[once], chunk_of[once]
                delta = d_peak[chunk_of, where_filter]
                by = np.argsort(where_filter, kind="stable")
                cut = np.searchsorted(where_filter[by], np.arange(FILTERS + 1))
                for f in range(FILTERS):
                    r = by[cut[f] : cut[f + 1]]
                    sel[f] += delta[r] @ xb[where_row[r]]
                    sel2[f] += delta[r] @ xb[np.minimum(where_row[r] + 1, len(xb) - 1)]
                bias += np.bincount(where_filter, delta, FILTERS).astype(np.float32)
            grads[:3] = sel.T, sel2.T, bias
            step += 1
            rate = 0.004 * (0.5 if step >= STEPS // 2 else 1)
            for a, ga, ma, va in zip(p, grads, m, v, strict=True):
                ma += 0.1 * (ga - ma)
                va += 0.01 * (ga * ga - va)
                a -= rate * (ma / (1 - 0.9**step)) / (np.sqrt(va / (1 - 0.99**step)) + 1e-7)
    return Network(p[0], p[1], p[2], p[3], p[4], p[5], float(p[6][0]) + shift)


CHUNK_SCHEMA = T.StructType(
    [
        T.StructField("row_key", T.LongType()),
        T.StructField("row_label", T.IntegerType()),
        T.StructField("row_bytes", T.LongType()),
        T.StructField("chunk_no", T.IntegerType()),
        T.StructField("chunk", T.BinaryType()),
    ]
)


def _sample_chunks(row_chunks: int | None):
    def sample(batches):
        for batch in batches:
            data, off = flat_text(batch.column("text"))
            keys, labels = batch.column("row_key").to_pylist(), batch.column("row_label").to_pylist()
            for i in range(batch.num_rows):
                n = int(off[i + 1] - off[i])
                count = max(1, -(-n // CHUNK_BYTES))
                take = np.unique(np.linspace(0, count - 1, min(count, row_chunks or count)).astype(int))
                for k in range(0, len(take), SLICE):
                    part = take[k : k + SLICE].tolist()
                    starts = [int(off[i]) + c * CHUNK_BYTES for c in part]
                    raw = [data[lo : min(lo + CHUNK_BYTES + GROUP, int(off[i + 1]))].tobytes() for lo in starts]
                    m = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([keys[i]] * m, pa.int64()), pa.array([labels[i]] * m, pa.int32()), pa.array([n] * m, pa.int64()), pa.array(part, pa.int32()), pa.array(raw, pa.binary())],
                        names=CHUNK_SCHEMA.names,
                    )

    return sample


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS, row_chunks: int | None = None) -> Network:
    """Train on labelled rows for which ``learn`` (over ``doc_id``) holds.

    About ``sample_rows`` rows of each class are drawn by a hash of the id.
    Of each one all chunks are used, or ``row_chunks`` evenly spread ones.
    They are held in a file of the driver's temporary folder.
    Ids with no label, or with contradicting ones, are not used; without any
    labelled row the network gives every text 0.5, and with one class only
    that class's probability is high everywhere."""
    known = (
        labels.select(F.col("doc_id"), F.col("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .filter("low = high")
        .filter(learn)
        .select("doc_id", F.col("high").cast("int").alias("row_label"))
    )
    counts = {r["row_label"]: r["n"] for r in known.groupBy("row_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return untrained()
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("row_label") == label, F.lit(sample_rows / n)).otherwise(share)
    drawn = known.filter(unit_hash("doc_id") < share)
    sample = (
        docs.select("doc_id", "text")
        .join(F.broadcast(drawn), "doc_id")  # about sample_rows ids and labels a class, whatever the input
        .select(F.xxhash64("doc_id").alias("row_key"), "row_label", "text")
        .mapInArrow(_sample_chunks(row_chunks), CHUNK_SCHEMA)
    )
    width = CHUNK_BYTES + GROUP
    with tempfile.TemporaryFile() as file:
        rows = []
        for r in written(sample, "quality-sample").toLocalIterator():
            raw = bytes(r["chunk"])
            file.write(raw.ljust(width, b"\0"))
            rows.append((r["row_key"], r["chunk_no"], zlib.crc32(raw), r["row_label"], r["row_bytes"], len(raw), len(rows)))
        if not rows:  # none of the labelled ids is among the documents
            return untrained()
        file.flush()
        return _train_sample(np.memmap(file, np.uint8, "r", shape=(len(rows), width)), sorted(rows), counts)


def _train_sample(chunks: np.ndarray, rows: list[tuple], counts: dict[int, int]) -> Network:
    owner, labels_, sizes_, seen = [], [], [], {}
    for key, _, _, label, n, _, _ in rows:
        if key not in seen:
            seen[key] = len(labels_)
            labels_.append(label)
            sizes_.append(n)
        owner.append(seen[key])
    size, place = np.array([r[5] for r in rows], np.int64), np.array([r[6] for r in rows], np.int64)
    y = np.array(labels_, np.float32)
    ones, zeros = float(y.sum()), float(len(y) - y.sum())
    shift = 0.0
    if ones and zeros:
        shift = float(np.log(counts.get(1, 1) / counts.get(0, 1)) - np.log(ones / zeros))
    return train(chunks, size, np.array(owner, np.int64), np.array(sizes_, np.int64), y, shift, place)


def score_quality(docs: DataFrame, net: Network, text: str = "text", out: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` plus ``out``: the probability of label 1.
    A column of that name is replaced."""
    kept = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers

    def score(batches):
        model = shared.value
        for batch in batches:
            data, off = flat_text(batch.column(text))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score_bytes(data, off, model))], names=[*batch.schema.names, out])

    return kept.mapInArrow(score, T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())]))
