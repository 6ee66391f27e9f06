"""Numpy kernels against plain Python."""

import itertools
import random

import numpy as np

from clickweir.llm import substring_dedup as passages
from clickweir.llm import suffix_dedup, suffix_sort
from clickweir.llm.ann import fit_lists, scan_block
from clickweir.llm.jaccard_join import DEPTH, TARGET, TREES, forest_labels, link_rows, matched_depth, meeting_probability, prefixes
from clickweir.llm.langid import viterbi
from clickweir.llm.suffix_dedup import find_anchors, merged, repeats_in
from clickweir.llm.suffix_sort import adjacent_common, suffix_order
from clickweir.llm.words import find_words, mix, row_shingles
from helpers import words


def flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def test_words_are_those_of_the_pattern():
    texts = ["Ab c1 é—x", "", "__", "ZZ", "a b c d e f", "日本 x", "end", "start"]
    data, off = flat(texts)
    start, length, hashes, counts = find_words(data, off)
    found = [data[a : a + n].tobytes().decode().lower() for a, n in zip(start, length)]
    want = [words(t) for t in texts]
    assert found == list(itertools.chain.from_iterable(want))
    assert counts.tolist() == [len(w) for w in want]
    same = {}
    for w, h in zip(found, hashes.tolist()):
        assert same.setdefault(w, h) == h
    assert len(set(same.values())) == len(same)
    assert row_shingles(hashes, counts, 5)[1].tolist() == [max(1, len(w) - 4) if w else 0 for w in want]


def test_suffix_order_and_common_prefixes():
    rng = np.random.default_rng(0)
    for case in range(200):
        data = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(1, 60))).astype(np.uint8)
        data = np.tile(data, 3) if case % 3 == 0 else data
        data = data + np.uint8(251) if case % 5 == 0 else data
        raw = data.tobytes()
        want = sorted(range(len(raw)), key=lambda i: raw[i:])
        order = suffix_order(data, 1000)
        assert order.tolist() == want

        def common(a, b):
            n = 0
            while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            return n

        assert adjacent_common(data, order, 1000).tolist() == [0] + [common(a, b) for a, b in zip(want, want[1:])]


def test_anchors_are_shared_by_equal_strings():
    rng = np.random.default_rng(2)
    length, gram = 12, 4
    for _ in range(100):
        lens = rng.integers(0, 60, 3)
        off = np.concatenate([[0], np.cumsum(lens)])
        data = rng.integers(0, int(rng.integers(1, 4)), int(off[-1])).astype(np.uint8)
        row, first, last, at, anchor, _ = find_anchors(data, off, length, gram)
        seen, by_string = set(), {}
        for r, a, b, p, h in zip(row, first, last, at, anchor):
            for s in range(a, b + 1):
                assert off[r] <= s and s + length <= off[r + 1] and s <= p <= s + length - gram
                seen.add(s)
                by_string.setdefault(data[s : s + length].tobytes(), set()).add((int(h), int(p - s)))
        assert seen == {s for r in range(3) for s in range(off[r], off[r + 1] - length + 1)}
        assert all(len(v) == 1 for v in by_string.values())


def test_repeats_in_cells():
    rnd = random.Random(3)
    for _ in range(60):
        length = rnd.randrange(2, 6)
        cells = [bytes(rnd.randrange(3) for _ in range(rnd.randrange(length, 14))) for _ in range(4)]
        strings = [(c, s, cells[c][s : s + length]) for c in range(4) for s in range(len(cells[c]) - length + 1)]
        counts = {}
        for _, _, x in strings:
            counts[x] = counts.get(x, 0) + 1
        want = {(c, s) for c, s, x in strings if counts[x] > 1}
        got = {(c, s) for c, a, b in repeats_in(cells, length) for s in range(a, b + 1)}
        assert got == want
    s, e = merged(np.array([5, 0, 2, 9]), np.array([7, 3, 5, 9]))
    assert (s.tolist(), e.tolist()) == ([0, 9], [7, 9])


def test_compact_windows_are_the_wide_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(1)
    for _ in range(150):
        off = np.concatenate([[0], np.cumsum(rng.integers(0, 30, int(rng.integers(1, 5))))])
        tokens = rng.integers(0, int(rng.integers(2, 40)), int(off[-1])).astype(np.uint64)
        width = int(rng.integers(1, 8))
        got = sorted(zip(*(x.tolist() for x in passages.compact_windows(tokens, off, width, np.uint64(7))[:4])))
        h = mix(tokens ^ np.uint64(7)) >> passages.PLACE_BITS
        want = []
        for r in range(len(off) - 1):
            for c in range(off[r], off[r + 1]):
                a = b = c
                while a > off[r] and h[a - 1] > h[c]:
                    a -= 1
                while b < off[r + 1] - 1 and h[b + 1] >= h[c]:
                    b += 1
                if b - a + 1 >= width:
                    want.append((r, a, c, b))
        assert got == sorted(want)


def test_passage_tiles_against_all_pairs():
    rng = np.random.default_rng(4)
    size, n_words, shift = 3, 12, 2
    width = n_words - size + 1
    for _ in range(60):
        base = [str(x) for x in rng.integers(0, int(rng.integers(3, 200)), 40)]
        texts, leads, starts = [], [], []
        for _ in range(4):
            x = list(base)
            for _ in range(int(rng.integers(0, 3))):
                p = int(rng.integers(0, len(x)))
                x[p : p + 1] = [str(rng.integers(0, 200))] if rng.random() < 0.5 else []
            a, n = int(rng.integers(0, 5)), int(rng.integers(1, 9))
            texts.append(x[a : a + n + n_words - 1])
            starts.append(len(texts[-1]) - n_words + 1)
            leads.append(int(rng.integers(0, 3)))
        tokens = [[tuple(t[i : i + size]) for i in range(len(t) - size + 1)] for t in texts]
        want = set()
        for i, j in itertools.permutations(range(4), 2):
            for s, t in itertools.product(range(starts[i]), range(starts[j])):
                if abs((t - leads[j]) - (s - leads[i])) <= shift:
                    a, b = set(tokens[i][s : s + width]), set(tokens[j][t : t + width])
                    if 5 * len(a & b) >= 4 * len(a | b):
                        want.add((i, s))
        runs = passages.verify_tile([" ".join(t).encode() for t in texts], np.arange(4), np.zeros(4, bool), np.array(starts), np.array(leads), np.arange(4), np.arange(4), n_words, size, 0.8, shift)
        assert {(m, s) for m, a, b in runs for s in range(a, b + 1)} == want


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(5)
    for _ in range(40):
        counts = rng.integers(0, 6, 4)
        scores = rng.normal(0, 3, (3, int(counts.sum()))).astype(np.float32)
        state = viterbi(np.ascontiguousarray(scores), counts, 2.0)
        ends = np.cumsum(counts)
        for e, n in zip(ends, counts):
            own = scores[:, e - n : e]

            def value(path):
                return sum(own[s, t] for t, s in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

            best = max((value(p) for p in itertools.product(range(3), repeat=int(n))), default=0)
            assert abs(value(state[e - n : e].tolist()) - best) < 1e-3


def test_links_against_all_pairs_and_depth_meets_its_target():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 60, 60).astype(np.uint64)
    sets = []
    for _ in range(30):
        x = base.copy()
        n = int(rng.integers(0, 14))
        x[rng.choice(60, n, replace=False)] = rng.integers(0, 1 << 60, n).astype(np.uint64)
        sets.append(np.unique(x))
    keys, copies = np.arange(30), rng.integers(1, 4, 30)
    tries = np.zeros((30, 2), np.int64)  # all meet
    near = [[len(set(a) & set(b)) * 5 >= 4 * len(set(a) | set(b)) for b in sets] for a in sets]
    everyone = np.arange(30)
    links, label = link_rows(keys, copies, tries, sets, everyone, everyone, 0.8)
    assert links.tolist() == [sum(copies[j] for j in range(30) if j != i and near[i][j]) for i in range(30)]
    # tiles of two blocks add up to the same
    a, b = everyone[:13], everyone[13:]
    parts = [link_rows(keys, copies, tries, sets, x, y, 0.8)[0] for x, y in ((a, a), (b, b), (a, b))]
    assert sum(parts).tolist() == links.tolist()
    assert all(label[i] == label[j] for i in range(30) for j in range(30) if near[i][j] and i != j)
    depth = matched_depth(0.8, 0.999)
    assert meeting_probability(0.8, depth, TREES) >= 0.999 > meeting_probability(0.8, depth + 1, TREES)


def pairs_at(shared, union, n, seed):
    """``n`` pairs of sets of that similarity, one after another."""
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(n):
        x = rng.integers(0, 1 << 62, union).astype(np.uint64)
        own = (union - shared) // 2
        sets += [np.unique(x[: shared + own]), np.unique(np.concatenate([x[:shared], x[shared + own :]]))]
    return sets


def test_trees_meet_as_often_as_the_similarity_says():
    for shared, union in ((80, 100), (90, 100), (50, 100)):
        sets = pairs_at(shared, union, 1500, shared)
        labels = forest_labels(np.concatenate(sets), np.array([len(x) for x in sets]))
        for depth in (2, 5, DEPTH):
            cut = prefixes(labels, depth)
            met = (cut[0::2] == cut[1::2]).any(axis=1).mean()
            want = meeting_probability(shared / union, depth, TREES)
            assert abs(met - want) < 4 * (want * (1 - want) / 1500) ** 0.5 + 0.01
    assert meeting_probability(0.8, matched_depth(0.8, TARGET), TREES) >= TARGET


def test_prefixes_are_shortened_until_the_links_found_have_the_recall():
    # one word a set would do: the labels say which pairs meet, and where
    def tile(similar, labels, target):
        sets = [np.arange(100, dtype=np.uint64), np.arange(100 - similar, 200 - similar, dtype=np.uint64)]
        sets += [x + np.uint64(1 << 40) for x in pairs_at(86, 100, 1, 3)]
        keys = everyone = np.arange(4)
        return link_rows(keys, np.ones(4, np.int64), labels, sets, everyone, everyone, 0.8, DEPTH - 1, target)[0].tolist()

    whole = np.array([[1], [1], [256], [257]], np.uint64)  # the second pair only meets above the last value
    assert tile(99, whole, 0.999) == [1, 1, 1, 1]  # one tree: 0.98 ** 8 is too little, so it goes on
    assert tile(99, whole, 0.5) == [1, 1, 0, 0]  # enough at whole labels
    apart = np.array([[1], [3 << 16], [256], [257]], np.uint64)
    assert tile(99, apart, 0.5) == [0, 0, 1, 1]  # nothing found: never an early stop


def test_block_scan_finds_the_exact_best():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 32))
    lists = fit_lists(np.arange(400), x, 5)
    q = rng.normal(size=(6, 32))
    got = dict((i, (ids.tolist(), s)) for i, ids, s in scan_block(np.full(6, -1), q, np.full(6, -np.inf), np.arange(400), x, lists.rotation, 5))
    hits = 0
    for i in range(6):
        exact = x @ q[i]
        hits += len(set(got[i][0]) & set(np.argsort(-exact)[:5]))
        assert np.allclose(got[i][1], exact[got[i][0]])
    assert hits >= 27


def test_block_scan_keeps_what_is_alike():
    rng = np.random.default_rng(3)
    q = rng.normal(size=(5, 64))
    x = np.concatenate([q + 0.2 * rng.normal(size=(40, 5, 64))[i] for i in range(40)] + [rng.normal(size=(300, 64))])
    rotation = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    exact = x @ q.T
    bound = np.sort(exact, axis=0)[-10]
    got = {i: ids.tolist() for i, ids, _ in scan_block(np.full(5, -1), q, bound, np.arange(500), x, rotation, 10)}
    assert [set(got[i]) for i in range(5)] == [set(np.argsort(-exact[:, i])[:10].tolist()) for i in range(5)]


def test_cuts_of_a_long_row_keep_every_start_place():
    rnd = random.Random(12)
    data = np.array([rnd.choice(b"abc ") for _ in range(5000)], np.uint8)
    offsets = np.array([0, 300, 4100, 4100, 5000])

    def by_place(limit):
        out = {}
        for i, j, lo, hi in suffix_dedup._pieces(offsets, 60, limit):
            row, a, b, _, anchor, _ = suffix_dedup.find_anchors(data[lo:hi], np.clip(offsets[i : j + 1], lo, hi) - lo, 60, 10)
            for r, x, y, h in zip(row, a, b, anchor, strict=True):
                for place in range(x, y + 1):
                    assert out.setdefault((i + r, place + lo), h) == h
        return out

    whole = by_place(1 << 20)
    assert len(whole) == sum(max(0, n - 59) for n in np.diff(offsets))
    assert by_place(700) == whole and by_place(61) == whole


def test_words_sort_like_bytes_even_with_zeros():
    rnd = random.Random(13)
    for _ in range(60):
        data = np.array([rnd.choice([0, 0, 1, 255]) for _ in range(rnd.randrange(1, 90))], np.uint8)
        raw = data.tobytes()
        places = np.flatnonzero(np.array([rnd.random() < 0.7 for _ in raw]))
        got = suffix_sort.sorted_places(places, suffix_sort.packed_words(data, 48), 40)
        assert [raw[i : i + 40] for i in got] == sorted(raw[i : i + 40] for i in places) and sorted(got.tolist()) == places.tolist()
