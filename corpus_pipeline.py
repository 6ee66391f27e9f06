"""Corpus pipeline: from raw documents to clean, tokenized ones.

Each stage calls one operator of ``clickweir.llm`` and takes and returns the
columns of ``documents``; the last adds the token ids. Stages are written as
Parquet to the shared folder and read again by the next.

Null and empty texts pass the stages unchanged unless the classifier rejects
them; rows with null ids are handled like any others. An empty table gives
an empty result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm.common import id_mod, wrapped, written
from clickweir.llm.decontaminate import decontaminate
from clickweir.llm.jaccard_join import jaccard_groups
from clickweir.llm.quality import fit_quality, score_quality
from clickweir.llm.queries import QUALITY_CUT, contaminated, hit_words
from clickweir.llm.sentencepiece_codec import encode_texts, load_model, token_count
from clickweir.llm.suffix_dedup import remove_repeats

# Passages of more than 50 words that documents share are to go: the shortest
# seen have 285 bytes. A string is routed by its grams, so these are shorter too.
PASSAGE_BYTES = 250
PASSAGE_GRAM = 40


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    network = fit_quality(docs, labels, id_mod("doc_id", 5) != 0)
    return score_quality(wrapped(docs, "text"), network).filter(F.col("quality_score") >= QUALITY_CUT).select("row.*")


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id.
    Documents without words are no copies of each other."""

    def row_key(text_key):
        return F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id"), text_key)

    groups = jaccard_groups(docs.select("doc_id", "text")).filter("kept")
    kept = groups.select(row_key(F.col("text_key")).alias("kept_key"), F.col("alone")).distinct()
    # a repeated row is a copy too, unless it has no words
    own = wrapped(docs, row_key(F.xxhash64("text")).alias("row_key")).join(kept, F.col("row_key") == F.col("kept_key"))
    return own.withColumn("tie", F.when(F.col("alone"), F.monotonically_increasing_id())).dropDuplicates(["row_key", "tie"]).select("row.*")


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of ``PASSAGE_BYTES`` bytes that occur twice."""
    cut = remove_repeats(wrapped(docs, "doc_id", "text"), length=PASSAGE_BYTES, gram=PASSAGE_GRAM)
    changed = F.col("kept_text").isNotNull()
    new = {
        "text": F.when(changed, F.col("kept_text")).otherwise(F.col("row.text")),
        "n_chars": F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col("row.n_chars")),
    }
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = decontaminate(wrapped(docs, "text"), items.select("item_id", "text"))
    return marked.withColumn("n_hit", hit_words()).filter(~contaminated()).select("row.*")


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their SentencePiece ids, which decode to the text."""
    coded = encode_texts(wrapped(docs, "text"), load_model())
    return coded.withColumn("n_tokens", token_count()).select("row.*", "token_ids", "n_tokens")


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("suffix-array dedup", suffix_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding", tokens_stage),
]

# A trained classifier and a Viterbi segmentation have no SQL; the run is tested against
# brute-force versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.lower().replace(" ", "-"))
    return docs
