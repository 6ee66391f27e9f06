"""Language identification of mixed-language text.

Words are runs of ASCII letters and non-ASCII characters. The script of a word (Unicode ranges) narrows
its candidate languages to those seen in that script while learning; a
smoothed letter n-gram model scores the word under each candidate; Viterbi
over the words of a document, with a fixed penalty for switching language,
labels spans. A document's language is the one whose spans hold most
letters, its score that share.

Null texts and texts without a letter: ``und``, score 0, no spans. Ties go
to the language first in name order. Rows are labelled one by one, so repeated
rows and null ids are kept. With nothing to learn from every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.llm.common import flat_text, row_pieces, unit_hash
from clickweir.llm.words import LETTERS, find_words

# First code point of Unicode ranges and the script found there.
SCRIPT_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "other"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1400, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPT_STARTS = np.array([s for s, _ in SCRIPT_RANGES])
SCRIPTS = sorted({s for _, s in SCRIPT_RANGES})
SCRIPT_OF = np.array([SCRIPTS.index(s) for _, s in SCRIPT_RANGES])

BUCKETS = 1 << 16
SIZES = (1, 3)
SAMPLE_ROWS = 1500
MAX_LANGUAGES = 256
SWITCH_PENALTY = 6.0
PIECE = 8 << 20
UNKNOWN = "und"


def distinct_words(data: np.ndarray, offsets: np.ndarray):
    """(word ids, keys and places of the distinct words, words per row,
    starts and lengths of all words) of a flat byte array."""
    start, length, key, counts = find_words(data, offsets, LETTERS)
    ids, unique = pd.factorize(key)
    place = np.zeros(len(unique), np.int64)
    place[ids[::-1]] = np.arange(len(ids) - 1, -1, -1)
    return ids, unique, place, counts, start, length


def texts_at(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[str]:
    raw = data.tobytes()
    return [raw[a : a + n].decode("utf-8", "replace").lower() for a, n in zip(start.tolist(), length.tolist(), strict=True)]


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words with a space on either side, and starts."""
    flat = np.frombuffer(("".join(f" {w} " for w in words)).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def script_ids(words: list[str]) -> np.ndarray:
    """Script of each word's first character."""
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    return SCRIPT_OF[np.searchsorted(SCRIPT_STARTS, first, side="right") - 1]


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of every letter n-gram inside the padded words."""
    flat, starts = _codes(words)
    owner = np.repeat(np.arange(len(words)), np.diff(starts))
    ids, keys = [], []
    rolling = np.zeros(len(flat), np.uint64)
    for n in range(1, max(SIZES) + 1):
        m = len(flat) - n + 1
        if m <= 0:
            break
        rolling = rolling[:m] * np.uint64(0x100000001B3) + flat[n - 1 :].astype(np.uint64) + np.uint64(1)
        if n not in SIZES:
            continue
        inside = owner[:m] == owner[n - 1 :]
        if n == 1:
            inside &= flat[:m] != 32
        mixed = (rolling + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        ids.append(owner[:m][inside])
        keys.append((mixed >> np.uint64(48))[inside].astype(np.int64))
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(ids), np.concatenate(keys)


@dataclass
class LanguageModel:
    languages: list[str]
    grams: np.ndarray  # (BUCKETS, languages) log probability of a bucket
    scripts: np.ndarray  # (scripts, languages) True where the language uses it


def word_scores(words: list[str], model: LanguageModel) -> np.ndarray:
    """Log posterior of each candidate language per word, floored at -12."""
    k = len(model.languages)
    ids, keys = gram_buckets(words)
    total = np.stack([np.bincount(ids, model.grams[keys, j], len(words)) for j in range(k)], axis=1)
    # overlapping n-grams repeat the same evidence
    total /= 2
    allowed = model.scripts[script_ids(words)]
    allowed |= ~allowed.any(axis=1, keepdims=True)
    total = np.where(allowed, total, -np.inf)
    total -= total.max(axis=1, keepdims=True)
    total -= np.log(np.exp(total).sum(axis=1, keepdims=True))
    return np.maximum(total, -12).astype(np.float32)


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best state of every word; ``scores`` is (states, words), with the words
    of the documents one after another, ``counts`` words per document.
    Documents advance together, longest first; only the best previous state
    can be switched from, so a step costs one maximum over the states."""
    k = len(scores)
    state = np.zeros(scores.shape[1], np.int16)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    if not len(order) or k == 1:
        return state
    starts = (np.cumsum(counts) - counts)[order]
    lengths = counts[order]
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    best = np.ascontiguousarray(scores[:, starts])
    stay = np.zeros(scores.shape, bool)
    source = np.zeros(scores.shape[1], np.int16)
    for t in range(1, int(lengths[0])):
        m = active[t]
        at = starts[:m] + t
        now = best[:, :m]
        top = now.max(axis=0)
        now -= top  # the best state stands at 0
        stay[:, at] = now >= -penalty
        source[at] = now.argmax(axis=0)
        np.maximum(now, -penalty, out=now)
        now += scores[:, at]
    final = best.argmax(axis=0).astype(np.int16)
    for t in range(int(lengths[0]) - 1, -1, -1):
        m = active[t]
        at = starts[:m] + t
        current = final[:m]
        state[at] = current
        if t:
            final[:m] = np.where(stay[current, at], current, source[at])
    return state


class WordScores:
    """Scores and letter counts of words by hash, remembered between
    batches up to ``limit`` words."""

    def __init__(self, model: LanguageModel, limit: int = 400_000):
        self.model, self.limit = model, limit
        self.forget()

    def forget(self) -> None:
        self.index: dict[int, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)
        self.letters = np.zeros(0)

    def rows(self, data: np.ndarray, unique: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        if len(self.index) > self.limit:
            self.forget()
        keys = unique.tolist()
        new = [i for i, w in enumerate(keys) if w not in self.index]
        if new:
            words = texts_at(data, start[new], length[new])
            self.index.update((keys[i], len(self.letters) + j) for j, i in enumerate(new))
            self.scores = np.concatenate([self.scores, word_scores(words, self.model)])
            self.letters = np.concatenate([self.letters, [sum(map(str.isalpha, w)) for w in words]])
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))


def label_words(data: np.ndarray, offsets: np.ndarray, score: WordScores):
    """(letters per word, words per row, language index per word, starts, lengths)."""
    ids, unique, place, counts, start, length = distinct_words(data, offsets)
    if not len(ids) or not score.model.languages:
        return np.zeros(len(ids)), counts, np.zeros(len(ids), np.int16), start, length
    rows = score.rows(data, unique, start[place], length[place])[ids]
    return score.letters[rows], counts, viterbi(np.ascontiguousarray(score.scores.T)[:, rows], counts), start, length


def predict(data: np.ndarray, offsets: np.ndarray, score: WordScores) -> tuple[list[str], np.ndarray]:
    """(language, share of letters) per row."""
    letters, counts, state, _, _ = label_words(data, offsets, score)
    n, languages = len(offsets) - 1, score.model.languages
    k = len(languages)
    if not k:
        return [UNKNOWN] * n, np.zeros(n)
    doc = np.repeat(np.arange(n), counts)
    mass = np.bincount(doc * k + state, letters, n * k).reshape(n, k)
    total = mass.sum(axis=1)
    names = [languages[j] if t > 0 else UNKNOWN for j, t in zip(mass.argmax(axis=1), total, strict=True)]
    return names, np.where(total > 0, mass.max(axis=1) / np.maximum(total, 1), 0.0)


def spans(text: str | None, model: LanguageModel) -> list[tuple[int, int, str]]:
    """(start, end, language) character spans of one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    letters, _, state, start, length = label_words(data, np.array([0, len(raw)]), WordScores(model))
    place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    out: list[tuple[int, int, str]] = []
    for a, n, s, count in zip(start, length, state, letters, strict=True):
        if not count:
            continue
        name, end = model.languages[s], int(place[a + n])
        if out and out[-1][2] == name:
            out[-1] = (out[-1][0], end, name)
        else:
            out.append((int(place[a]), end, name))
    return out


COUNT_SCHEMA = T.StructType(
    [T.StructField("gram_lang", T.StringType()), T.StructField("gram", T.IntegerType()), T.StructField("n", T.LongType())]
)


def _count_grams(batches):
    for batch in batches:
        langs = np.array(batch.column("gram_lang").to_pylist(), object)
        for lang in sorted(set(langs)):
            data, off = flat_text(batch.column("text").filter(pa.array(langs == lang)))
            ids, _, place, _, start, length = distinct_words(data, off)
            unique = texts_at(data, start[place], length[place])
            times = np.bincount(ids)
            # characters that are no letters do not speak for a language
            known = [i for i, w in enumerate(unique) if any(map(str.isalpha, w))]
            if not known:
                continue
            unique, times = [unique[i] for i in known], times[known]
            owner, keys = gram_buckets(unique)
            grams = np.bincount(keys, times[owner], BUCKETS)
            scripts = np.bincount(script_ids(unique), times, len(SCRIPTS))
            both = np.concatenate([grams, scripts])
            hit = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(hit)), pa.array(hit, pa.int32()), pa.array(both[hit].astype(np.int64))],
                names=COUNT_SCHEMA.names,
            )


def fit_languages(docs: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from ``text`` and non-null ``lang`` of the rows for which
    ``learn`` holds, about ``sample_rows`` rows a language, drawn by a hash of
    the id. The driver receives at most ``BUCKETS`` counts a language; more
    than ``MAX_LANGUAGES`` languages are refused."""
    rows = docs.select("doc_id", "text", "lang").filter(learn).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPTS), 0), bool))
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(sample_rows / n)).otherwise(share)
    tally = (
        rows.filter(unit_hash("doc_id") < share)
        .select(F.col("lang").alias("gram_lang"), "text")
        .mapInArrow(_count_grams, COUNT_SCHEMA)
        .groupBy("gram_lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(tally["gram_lang"].unique())
    table = np.zeros((BUCKETS + len(SCRIPTS), len(languages)))
    table[tally["gram"].to_numpy(), np.searchsorted(languages, tally["gram_lang"].to_numpy(str))] = tally["n"].to_numpy()
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    smooth = 0.5
    logs = np.log(grams + smooth) - np.log(grams.sum(axis=0) + smooth * BUCKETS)
    used = scripts >= 0.01 * np.maximum(scripts.sum(axis=0), 1)
    return LanguageModel([str(x) for x in languages], logs.astype(np.float32), used & (scripts > 0))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``lang_score``
    (replaced if they are there)."""
    kept = docs.drop("lang_pred", "lang_score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers

    def label(batches):
        score = WordScores(shared.value)
        for batch in batches:
            data, off = flat_text(batch.column(text))
            names, shares = [], []
            for i, j in row_pieces(off, PIECE):
                a, b = predict(data[off[i] : off[j]], off[i : j + 1] - off[i], score)
                names += a
                shares.append(b)
            got = np.concatenate(shares) if shares else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(got, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "lang_score"],
            )

    fields = [*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]
    return kept.mapInArrow(label, T.StructType(fields))
