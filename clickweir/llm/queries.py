"""Registered queries of this subpackage: ``opN_<name>`` applies operator N
to its whole table and derives the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm.ann import nearest
from clickweir.llm.bloom_search import search
from clickweir.llm.common import id_mod
from clickweir.llm.decontaminate import decontaminate
from clickweir.llm.html_extract import extract_main_text
from clickweir.llm.jaccard_join import jaccard_groups
from clickweir.llm.langid import fit_languages, identify
from clickweir.llm.oracle_sql import ORACLES
from clickweir.llm.periodic_runs import find_runs
from clickweir.llm.quality import fit_quality, score_quality
from clickweir.llm.sentencepiece_codec import encode_texts, load_model, token_count
from clickweir.llm.simhash_trie import simhash_components
from clickweir.llm.substring_dedup import near_duplicate_passages
from clickweir.llm.suffix_dedup import remove_repeats
from clickweir.llm.token_counts import count_tokens, token_type, write_token_files

QUALITY_CUT = 0.3
# Fixed value: the id of </s> in the piece model, which no text encodes to.
END_OF_DOCUMENT = 2


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = fit_languages(docs, id_mod("doc_id", 4) != 2)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(id_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    coded = encode_texts(docs, load_model(), checked="round_trip")
    return coded.select("doc_id", token_count().alias("n_tokens"), "token_ids", "round_trip")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicate_passages(read(spark, sf_dir, "documents", "doc_id", "text"))
    covered = F.aggregate("passages", F.lit(0).cast("long"), lambda total, p: total + p["stop"] - p["start"])
    return found.select("doc_id", "n_words", covered.alias("n_dup_words"), F.size("passages").cast("long").alias("n_passages"), "passages")


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit"):
    """At least a twentieth of the words, and at least one, lie in windows of items."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def hit_words():
    """Words inside the runs that ``decontaminate`` found."""
    runs = F.zip_with("hit_starts", "hit_ends", lambda a, b: b - a)
    return F.aggregate(runs, F.lit(0).cast("long"), lambda total, n: total + n)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    marked = decontaminate(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))
    return marked.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
    ).withColumn("contaminated", contaminated())


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract_main_text(pages).select(
        "page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars")
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda total, r: total + r["stop"] - r["start"])
    return cut.select(
        "doc_id",
        (F.octet_length("kept_bytes") + removed).alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept_bytes", 256).alias("kept_sha256"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(read(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "class_id", "n_links")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    network = fit_quality(docs, read(spark, sf_dir, "labels", "doc_id", "quality"), id_mod("doc_id", 5) != 0)
    return score_quality(docs, network).select(
        "doc_id",
        F.coalesce(id_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= QUALITY_CUT).cast("int").alias("predicted"),
    )


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = load_model()
    manifest = write_token_files(read(spark, sf_dir, "documents", "doc_id", "text"), model, END_OF_DOCUMENT)
    files = manifest.select("token_file", "file_bytes").distinct()
    counts = count_tokens(files, END_OF_DOCUMENT, token_type(model.size))
    return manifest.join(counts, ["token_file", "doc_no"]).select("doc_id", "n_tokens")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def with_period(docs: DataFrame) -> DataFrame:
    """The texts of ``op13``'s contract: in a tenth of the documents, by the
    hash of their ids, the words from one on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("w"))
    n, g = F.size("w"), F.col("g")
    placed = words.select("*", F.when(n > 0, g % n).cast("int").alias("a")).select("*", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int").alias("p"))
    rest = n - F.col("a")
    copies = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    changed = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(copies, F.lit(1), rest))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(with_period(read(spark, sf_dir, "documents", "doc_id", "text")))
    # the greatest length first, then the least start and period
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), lines.alias("lines"), "collapsed_text").select(
        "doc_id",
        "n_runs",
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = (op1_language_id, op2_sentencepiece, op3_substring_dedup, op4_benchmark_decontamination, op5_html_extraction, op6_suffix_dedup, op7_jaccard_join, op8_quality_classifier, op9_nearest_neighbours, op10_token_counts, op11_lexical_search, op12_simhash_dedup, op13_periodic_runs)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_queries() -> dict[str, str]:
    return ORACLES
