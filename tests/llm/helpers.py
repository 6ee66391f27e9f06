"""Small tables and brute-force versions for the training-data operators."""

import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def shingles(text, size=5):
    w = words(text)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def prose(rnd, n, vocabulary=4000):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def documents(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, DOCS)


def awkward(rnd=None):
    """Null, empty, wordless, short, repeated, very long rows; null ids."""
    rnd = rnd or random.Random(0)
    long = prose(rnd, 30_000)
    return [
        (1, None), (2, ""), (3, " \n\t--"), (4, "one"), (5, "ein é ▁ \u0000 wort"), (6, "same text here"), (6, "same text here"), (None, "no id"), (None, None),
        (7, long), (8, "x" * 5000),
    ]
