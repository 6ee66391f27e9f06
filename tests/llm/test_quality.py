"""Training sees all of its rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from clickweir.llm import quality
from clickweir.llm.quality import fit_quality
from helpers import documents, prose


def test_all_bytes_of_the_drawn_rows_are_trained_on(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(1, prose(rnd, 4000)), (2, "short"), (3, "x" * 512), (4, None), (5, prose(rnd, 300_000))]
    docs, known = documents(spark, rows), spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    seen = []

    def train(chunks, sizes, owner, n_bytes, labels, shift, place):
        seen.append(sorted(b"".join(chunks[place[k]][: min(sizes[k], quality.CHUNK_BYTES)].tobytes() for k in np.flatnonzero(owner == i)) for i in range(len(labels))))
        return quality.untrained()

    monkeypatch.setattr(quality, "train", train)
    fit_quality(docs, known, F.lit(True))
    assert seen == [sorted((t or "").encode() for _, t in rows)]
    fit_quality(docs, known, F.lit(True), row_chunks=2)
    assert sorted(map(len, seen[1])) == sorted(min(len(t or ""), 1024 if len(t or "") % 512 == 0 else 512 + len(t or "") % 512) for _, t in rows)


def test_slices_of_a_batch_train_the_same_network(monkeypatch):
    monkeypatch.setattr(quality, "STEPS", 3)
    rng = np.random.default_rng(0)
    chunks = rng.integers(0, 256, (60, quality.CHUNK_BYTES + quality.GROUP)).astype(np.uint8)
    sizes, owner = rng.integers(1, chunks.shape[1], 60), np.sort(rng.integers(0, 9, 60))
    args = (chunks, sizes, owner, np.bincount(owner, sizes, 9), (np.arange(9) % 2).astype(np.float32), 0.0, rng.permutation(60))
    whole = quality.train(*args)
    monkeypatch.setattr(quality, "SLICE", 7)
    cut = quality.train(*args)
    assert np.allclose(whole.left, cut.left, atol=1e-4) and np.allclose(whole.dense, cut.dense, atol=1e-4)


def naive_score(text, net):
    """The network by its definition: one chunk, one place, one filter at a time."""
    group, chunk = quality.GROUP, quality.CHUNK_BYTES
    key = lambda b, i: ((int.from_bytes(b[i : i + 4], "little") * 2654435761 & 0xFFFFFFFF) >> 16) if i + 4 <= len(b) else None
    total, groups = np.zeros(quality.FILTERS), 0
    for at in range(0, len(text), chunk):
        own = text[at : at + chunk + group]
        rows = []
        for i, b in enumerate(own):
            back = next((k for k in range(1, quality.RECENT) if i >= k and key(own, i) is not None and key(own, i - k) == key(own, i)), None)
            rows.append([*quality.BYTES[b], 2 * (1 - back / quality.RECENT) if back else 0.0])
        rows += [[0.0] * quality.WIDTH] * (3 * group)
        n = -(-min(len(own), chunk) // group)
        best = np.zeros(quality.FILTERS)
        for g in range(n):
            two = np.array(rows[g * group : (g + 2) * group], np.float64)
            best = np.maximum(best, two[:group].ravel() @ net.left + two[group:].ravel() @ net.right + net.bias)
        total, groups = total + n * best, groups + n
    pooled = np.append(total / max(groups, 1), np.log1p(len(text)) / 10)
    return 1 / (1 + np.exp(-(np.tanh(pooled @ net.dense + net.dense_bias) @ net.out + net.out_bias)))


def some_network(seed=1):
    rng = np.random.default_rng(seed)
    net = quality.untrained()
    return quality.Network(*(rng.normal(0, 0.3, a.shape).astype(np.float32) for a in (net.left, net.right, net.bias, net.dense, net.dense_bias, net.out)), 0.1)


def test_scores_against_the_definition(monkeypatch):
    rnd = random.Random(8)
    texts = [prose(rnd, n).encode() for n in (0, 1, 3, 70, 110, 400, 2500)]
    texts += [prose(rnd, 400).encode()[:n] for n in (511, 512, 513, 514, 516, 517, 1024, 1025, 1028)]
    texts += [b"", b"a", b"abc", b"abcd" * 300, "é日 ".encode() * 200, bytes(range(256)) * 3]
    net, off = some_network(), np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    want = [naive_score(t, net) for t in texts]
    assert np.allclose(quality.score_bytes(data, off, net), want, atol=1e-4)
    monkeypatch.setattr(quality, "SCORED", 3)  # whatever is scored together
    assert np.allclose(quality.score_bytes(data, off, net), want, atol=1e-4)


def test_training_pools_what_scoring_pools(monkeypatch):
    text = prose(random.Random(9), 600).encode()
    net = some_network()
    cuts = [text[i : i + quality.CHUNK_BYTES + quality.GROUP] for i in range(0, len(text), quality.CHUNK_BYTES)]
    data, sizes = np.frombuffer(b"".join(cuts), np.uint8), np.array([len(c) for c in cuts])
    _, _, _, peak, share = quality.chunk_peaks(data, sizes, net.left, net.right, net.bias)
    pooled = np.append((peak * share[:, None]).sum(0) / share.sum(), np.log1p(len(text)) / 10)
    own = 1 / (1 + np.exp(-quality._head(pooled[None, :], net)[0]))
    assert abs(own - quality.score_bytes(np.frombuffer(text, np.uint8), np.array([0, len(text)]), net)[0]) < 1e-4
