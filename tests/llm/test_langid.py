"""``op1_language_id`` against a plain version of it: words, letter n-grams,
counts, scores and the best path, one document and one word at a time."""

import math
import re
import zlib
from collections import Counter, defaultdict

import __spark_entry__ as entry
from clickweir.llm.langid import BUCKETS, SCRIPT_RANGES, SWITCH_PENALTY
from conftest import SF_SMALL

LETTERS = re.compile("[A-Za-z\u0080-\U0010ffff]+")


def grams(word):
    padded = f" {word} "
    for size in (1, 3):
        for i in range(len(padded) - size + 1):
            gram = padded[i : i + size]
            if gram == " ":
                continue
            key = 0
            for c in gram:
                key = (key * 0x100000001B3 + ord(c) + 1) % (1 << 64)
            yield ((key + size) * 0x9E3779B97F4A7C15 % (1 << 64)) >> 48


def script(word):
    return [name for start, name in SCRIPT_RANGES if start <= ord(word[0])][-1]


def learn(rows):
    counts, scripts = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 or r["lang"] is None or r["text"] is None:
            continue
        for w in LETTERS.findall(r["text"]):
            w = w.lower()
            if any(map(str.isalpha, w)):
                counts[r["lang"]].update(grams(w))
                scripts[r["lang"]][script(w)] += 1
    total = {lang: sum(c.values()) + 0.5 * BUCKETS for lang, c in counts.items()}
    used = {lang: {s for s, n in c.items() if n >= 0.01 * sum(c.values())} for lang, c in scripts.items()}
    return sorted(counts), lambda lang, g: math.log((counts[lang][g] + 0.5) / total[lang]), used


def scores(word, languages, log_of, used):
    able = [lang for lang in languages if script(word) in used[lang]] or languages
    found = list(grams(word))
    raw = {lang: sum(log_of(lang, g) for g in found) / 2 for lang in able}
    top = max(raw.values())
    norm = top + math.log(sum(math.exp(v - top) for v in raw.values()))
    return [max(raw[lang] - norm, -12.0) if lang in raw else -12.0 for lang in languages]


def best_path(rows):
    best, back = list(rows[0]), []
    for row in rows[1:]:
        top = max(range(len(best)), key=best.__getitem__)
        back.append([j if best[j] >= best[top] - SWITCH_PENALTY else top for j in range(len(best))])
        best = [max(best[j], best[top] - SWITCH_PENALTY) + row[j] for j in range(len(best))]
    path = [max(range(len(best)), key=best.__getitem__)]
    for row in reversed(back):
        path.append(row[path[-1]])
    return path[::-1]


def test_language_query_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    languages, log_of, used = learn(docs)
    known = {}
    want = {}
    for r in docs:
        words = [w.lower() for w in LETTERS.findall(r["text"] or "")]
        letters = [sum(map(str.isalpha, w)) for w in words]
        if not sum(letters):
            want[r["doc_id"]] = ("und", 0.0)
            continue
        for w in words:
            if w not in known:
                known[w] = scores(w, languages, log_of, used)
        mass = [0] * len(languages)
        for state, n in zip(best_path([known[w] for w in words]), letters, strict=True):
            mass[state] += n
        want[r["doc_id"]] = (languages[mass.index(max(mass))], max(mass) / sum(mass))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in entry.queries()["op1_language_id"](spark, SF_SMALL).collect()}
    assert got.keys() == want.keys()
    assert {i: v[0] for i, v in got.items()} == {i: v[0] for i, v in want.items()}
    # scores are kept in single precision, so a word between two equal paths may fall to the other one
    assert all(abs(got[i][1] - want[i][1]) < 0.01 for i in want)
