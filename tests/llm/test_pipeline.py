"""The pipeline against brute-force versions of its stages."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from clickweir.llm.sentencepiece_codec import decode_texts, load_model
from conftest import SF_SMALL
from helpers import awkward, documents, prose, shingles, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_columns_and_do_their_work(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("row", F.lit(1)).withColumn("quality_score", F.lit("x"))
    columns = [*COLUMNS, "row", "quality_score"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 13]) for w in items for i in range(max(1, len(w) - 12))}
    stages = dict(pipeline.STAGES)
    assert len(stages) == 5

    good = stages["quality classifier"](spark, docs, SF_SMALL).cache()
    assert good.columns == columns
    kept = {r["doc_id"] for r in good.collect()}
    judged = [(labels[i], i in kept) for i in (r["doc_id"] for r in docs.collect()) if i in labels]
    assert sum(q == k for q, k in judged) >= 0.95 * len(judged)

    single = stages["n-gram Jaccard join"](spark, good, SF_SMALL).cache()
    assert single.columns == columns
    before = {r["doc_id"]: shingles(r["text"]) for r in good.collect()}
    after = {r["doc_id"]: shingles(r["text"]) for r in single.collect()}
    near = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    ids = sorted(before)
    linked = {i: [j for j in ids if j != i and near(before[i], before[j])] for i in ids}
    group = {}
    for i in ids:  # least id of each component
        todo = [] if i in group else [i]
        while todo:
            j = todo.pop()
            if j not in group:
                group[j] = i
                todo += linked[j]
    assert set(after) == set(group.values())

    unique = stages["suffix-array dedup"](spark, single, SF_SMALL).cache()
    assert unique.columns == columns and unique.count() == single.count()
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in unique.collect()}
    raw = {r["doc_id"]: r["text"].encode() for r in single.collect()}
    seen, size = {}, pipeline.PASSAGE_BYTES
    for b in raw.values():
        for k in range(len(b) - size + 1):
            seen[b[k : k + size]] = seen.get(b[k : k + size], 0) + 1
    for i, b in raw.items():
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        want = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        assert texts[i][0] == want
        assert texts[i][1] == len(want) or not any(gone)

    clean = stages["benchmark decontamination"](spark, unique, SF_SMALL).cache()
    assert clean.columns == columns
    for i, (t, _) in texts.items():
        w = words(t)
        hit = set()
        for n in {len(x) for x in windows}:
            hit |= {k for s in range(len(w) - n + 1) if tuple(w[s : s + n]) in windows for k in range(s, s + n)}
        assert (clean.filter(F.col("doc_id") == i).count() == 0) == (len(hit) > 0 and 20 * len(hit) >= len(w)) if hit else True
    last = stages["SentencePiece encoding"](spark, clean, SF_SMALL)
    assert last.columns == [*columns, "token_ids", "n_tokens"]
    assert decode_texts(last, load_model()).filter(~F.col("decoded").eqNullSafe(F.col("text"))).count() == 0


def test_passages_of_over_fifty_words_go(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdeñéghilmnoprstu") for _ in range(rnd.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(51) for _ in range(8)]
    rows = [(i, f"{text(80)} {shared[i % 8]} {text(60)}") for i in range(24)] + [(100 + i, text(120)) for i in range(10)]
    left = {r["doc_id"]: r["text"] for r in pipeline.suffix_stage(spark, documents(spark, rows), SF_SMALL).collect()}
    for i, before in rows:
        if i >= 100:
            assert left[i] == before
            continue
        a = before.index(shared[i % 8])
        b = a + len(shared[i % 8])
        assert before[: a - 20] in left[i] and before[b + 20 :] in left[i]
        assert shared[i % 8][30:-30] not in left[i] and len(left[i]) <= len(before) - (b - a) + 4


def test_near_copies_of_awkward_rows(spark):
    rnd = random.Random(5)
    rows = [*awkward(), (60, prose(rnd, 40)), (61, None)]
    rows.append((62, rows[-2][1]))
    single = pipeline.jaccard_stage(spark, documents(spark, rows), SF_SMALL)
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in single.collect())
    # the repeated row and the copy go; wordless rows stay, null ids with them
    want = sorted({(i or 0, t or "", k if not words(t) else 0) for k, (i, t) in enumerate(rows) if i != 62})
    assert got == [(i, t) for i, t, _ in want]


def test_later_stages_keep_awkward_rows(spark):
    docs = documents(spark, [r for r in awkward() if r[0] not in (6, 8)])  # these repeat
    for stage in (pipeline.suffix_stage, pipeline.decontamination_stage, pipeline.tokens_stage):
        out = stage(spark, docs, SF_SMALL)
        assert out.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).count() == 0
        assert out.count() == docs.count()


def test_stages_on_an_empty_table(spark):
    docs = documents(spark, [])
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0, name
