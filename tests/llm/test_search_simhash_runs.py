"""Ranked search, SimHash components and periodic runs against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickweir.llm.bloom_search import search, width_for
from clickweir.llm.periodic_runs import Grammar, find_runs, runs_of
from clickweir.llm.queries import with_period
from clickweir.llm.simhash_trie import Node, fingerprint, linked_pairs, simhash_components
from conftest import SF_MID, SF_SMALL
from helpers import FOLD, awkward, documents, prose, words
from oracle_compare import compare, duck

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def with_clash(df, *names):
    for n in names:
        df = df.withColumn(n, F.lit("mine"))
    return df


# 11 --------------------------------------------------------------------------


def ranked(rows, items, places=10):
    docs = [(i, Counter(words(t))) for i, t in rows if words(t)]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in docs:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(words(text)) if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, k, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:places], 1)]
    return sorted(out, key=repr)


def as_tuples(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("item_block", [1 << 20, 60])
def test_search_equals_brute_force(spark, item_block):
    rnd = random.Random(7)
    rows = [*awkward(rnd), *((100 + i, prose(rnd, rnd.randrange(1, 400), 300)) for i in range(150))]
    rows += [(400 + i, "w1 w2 w3 " * (i % 5 + 1)) for i in range(30)] + [(500 + i, rows[30][1]) for i in range(25)]  # ties and copies
    items = [(1, "w1 w2"), (1, "W1 w2"), (2, None), (3, ""), (None, rows[30][1]), (4, "nowhere"), (5, prose(rnd, 40, 300)), (6, "ein WORT same"), (7, rows[9][1][:4000])]
    docs = with_clash(documents(spark, rows), "rank", "score", "items", "key_a", "item_id")
    asked = with_clash(items_frame(spark, items), "rank", "key_a", "doc_id")
    assert as_tuples(search(docs, asked, item_block=item_block)) == ranked(rows, items)


def test_search_of_empty_tables(spark):
    docs, items = documents(spark, [(1, "a b"), (2, None)]), items_frame(spark, [(1, "a")])
    assert search(docs.limit(0), items).count() == 0
    assert search(docs.filter("text IS NULL"), items).count() == 0
    assert search(docs, items.limit(0)).count() == 0
    assert as_tuples(search(docs, items)) == ranked([(1, "a b")], [(1, "a")])


def test_signatures_are_wide_enough():
    keys = np.array([1, 5, 100, 3000])
    assert (width_for(keys) >= np.maximum(14 * keys, 64)).all() and (width_for(keys) <= 1.5 * np.maximum(14 * keys, 64)).all()


def test_search_query_equals_sql(spark):
    ok, said = compare(entry.queries()["op11_lexical_search"](spark, SF_SMALL), duck(SF_SMALL), entry.oracle_sql()["op11_lexical_search"])
    assert ok, said


# 12 --------------------------------------------------------------------------


def simhash(text):
    w = SPACED.findall((text or "").translate(FOLD))
    if not w:
        return 0
    s = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints):
    """Index of the least fingerprint reachable, by all pairs."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(prints))]


def expected_components(rows):
    prints = [simhash(t) for _, t in rows]
    group = components(prints)
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted(((i, p, least.get(g)) for (i, _), p, g in zip(rows, prints, group, strict=True)), key=repr)


def edited(rnd, text, n):
    w = text.split()
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"x{rnd.randrange(999)}"
    return " ".join(w)


@pytest.mark.parametrize("block", [1 << 15, 40])
def test_components_equal_all_pairs(spark, block):
    rnd = random.Random(3)
    rows = [*awkward(rnd), (70, "One two"), (71, "one\ttwo"), (72, "a b c d e"), (None, "a b c d e")]
    for k in range(25):
        base = prose(rnd, rnd.randrange(60, 900))
        rows += [(100 + 10 * k + v, edited(rnd, base, v)) for v in range(6)]
    docs = with_clash(documents(spark, rows), "print", "component_id", "fingerprint", "root")
    got = simhash_components(docs, block=block).collect()
    assert sorted(((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in got), key=repr) == expected_components(rows)
    linked = Counter(c for _, _, c in expected_components(rows))
    assert max(linked.values()) >= 4  # the near copies do link


def test_components_query_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op12_simhash_dedup"](spark, SF_SMALL).collect()
    assert sorted(((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in got), key=repr) == expected_components(rows)
    assert all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) for r in got)


def test_components_of_an_empty_table(spark):
    assert simhash_components(documents(spark, [])).count() == 0


def test_trie_join_finds_each_pair_once():
    rnd = random.Random(9)
    base = [rnd.getrandbits(64) for _ in range(150)]
    near = [x ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 7))) for x in base for _ in range(3)]
    prints = np.unique(np.array([*base, *near, 0, 1, (1 << 64) - 1], np.uint64))
    want = [(i, j) for j in range(len(prints)) for i in range(j) if (int(prints[i]) ^ int(prints[j])).bit_count() <= 4]
    whole = Node(prints)
    found = [p for i, j in linked_pairs(whole, whole, 0, 0, 4) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert sorted(found) == sorted(want)
    cut = len(prints) // 3
    sides = Node(prints[:cut]), Node(prints[cut:])
    found = [(i, j + cut) for a, b in linked_pairs(*sides, 0, 0, 4) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    assert sorted(found) == sorted(p for p in want if p[0] < cut <= p[1])


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = prose(random.Random(2), 3000)
    whole = fingerprint(text.encode())
    monkeypatch.setattr("clickweir.llm.simhash_trie.HASHES", 100)
    assert fingerprint(text.encode()) == whole == simhash(text)


# 13 --------------------------------------------------------------------------


def naive_runs(w):
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)  # the least period comes first
            i = j + 1 if j > i else i + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def naive_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic(rnd, n, kinds):
    w = [f"v{rnd.randrange(kinds)}" for _ in range(n)]
    for _ in range(rnd.randrange(3)):
        p, at = rnd.randrange(1, 9), rnd.randrange(n + 1)
        part = (w[at : at + p] or ["z"]) * rnd.randrange(3, 9)
        w[at : at + p] = part[: len(part) - rnd.randrange(len(part) // 3 + 1)]
    return w


def test_runs_equal_naive_ones(monkeypatch):
    rnd = random.Random(11)
    for trial in range(400):
        if trial % 2:
            monkeypatch.setattr("clickweir.llm.periodic_runs.CANDIDATES", rnd.randrange(1, 50))
        texts = [periodic(rnd, rnd.randrange(70), rnd.choice([1, 2, 3, 20])) for _ in range(rnd.randrange(1, 5))]
        number = {}
        flat = [np.array([number.setdefault(x, len(number)) for x in t], np.int64) for t in texts]
        text, start, length, q = runs_of(flat)
        got = [[] for _ in texts]
        for k, *r in zip(text.tolist(), start.tolist(), length.tolist(), q.tolist(), strict=True):
            got[k].append(tuple(r))
        assert got == [sorted(naive_runs(t), key=lambda r: (r[0], r[2])) for t in texts]


def test_grammar_extensions_equal_direct_comparison():
    rnd = random.Random(4)
    for _ in range(60):
        texts = [[rnd.randrange(rnd.choice([1, 2, 5])) for _ in range(rnd.randrange(1, 120))] for _ in range(3)]
        sequence = [-1]
        for k, t in enumerate(texts):
            sequence += [*t, -2 - k]
        grammar = Grammar(np.array(sequence, np.int64))
        inner = [i for i, x in enumerate(sequence) if x >= 0]
        a, b = (np.array([rnd.choice(inner) for _ in range(80)]) for _ in range(2))
        apart = a != b
        a, b = a[apart], b[apart]
        for step in (1, -1):
            want = []
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                n = 0
                while sequence[i + n * step] == sequence[j + n * step]:
                    n += 1
                want.append(n)
            assert grammar.extension(a, b, step).tolist() == want


def test_runs_of_awkward_rows(spark):
    rnd = random.Random(6)
    rows = [*awkward(rnd), (80, "a " * 5), (81, "a " * 6), (82, "a\nb\t" * 4), (83, " ".join(periodic(rnd, 5000, 30))), (84, "é ü " * 9 + "x"), (85, "k " * 70_000)]
    found = find_runs(with_clash(documents(spark, rows), "runs", "d", "raw_text", "collapsed_text"))
    assert found.filter("d != 'mine' OR raw_text != 'mine'").count() == 0
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed_text"]) for r in found.collect()), key=repr)
    want = []
    for i, t in rows:
        w = SPACED.findall(t or "")
        runs = [(0, len(w), 1)] if i == 85 else sorted(naive_runs(w), key=lambda r: (r[0], r[2])) if len(w) < 20_000 else []
        want.append((i, len(w), runs, naive_collapsed(w, runs)))
    assert got == sorted(want, key=repr)
    assert find_runs(documents(spark, [])).count() == 0


def test_runs_query_equals_its_contract(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect() if len(r[1] or "") < 6000]
    small = spark.createDataFrame([*docs, (None, "no id " * 5), (30, None), (31, "")], "doc_id long, text string")
    changed = {}
    for r in with_period(small).collect():
        changed.setdefault(r["doc_id"], []).append(SPACED.findall(r["text"] or ""))
    whole = {r["doc_id"]: r for r in entry.queries()["op13_periodic_runs"](spark, SF_MID).collect()}
    with_runs = 0
    for i, text in docs:
        w = SPACED.findall(text or "")
        h, n = zlib.crc32(str(i).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        assert w in changed[i]
        runs = naive_runs(w) if n < 400 or h % 10 == 0 else None
        if runs is None:
            continue
        runs.sort(key=lambda r: (r[0], r[2]))
        with_runs += bool(runs)
        s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        got = whole[i]
        assert (got["n_runs"], got["start"], got["length"], got["period"]) == (len(runs), s, length, q)
        assert got["exponent_milli"] == (None if q is None else 1000 * length // q)
        assert got["runs_sha256"] == sha("".join(f"{a},{b},{c}\n" for a, b, c in runs))
        assert got["collapsed_sha256"] == sha(naive_collapsed(w, runs))
    assert with_runs > 10
    assert [SPACED.findall("no id " * 5)] == changed[None]
