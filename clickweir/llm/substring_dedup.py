"""Near-duplicate passages by compact windows.

A passage is ``WORDS`` consecutive words, as the set of its five-word
shingles; two are near duplicates if their Jaccard similarity reaches the
threshold. For each of ``HASHES`` hash functions, the Cartesian tree over the
hashed shingles of a text gives its compact windows (l, c, r): every
subsequence inside l..r that holds c has its least hash at c, so all
passages of the window share that signature. Windows meet by hash value.

* A near duplicate lacks but a few of a passage's shingles, so a passage with
  more that no other passage has is left out beforehand. Shingles meet as packed
  hashes, one row for those of a piece of texts that share ten bits; what comes
  back are the places of those that are met twice. Windows are those of the
  regions of text that are left, with passages of that kind only.
* A value seen in one text only cannot link texts.
* Windows with equal words in different texts are repeats from end to end.
* The distinct windows of a value are verified against each other. Members
  are cut into blocks of ``BLOCK`` windows and each pair of blocks is one
  tile; a tile joins the intervals in which shingles of two passages lie,
  at all offsets of the two, and returns, for each member, the runs of start
  words with a near duplicate; pairs are never returned.

Two passages at the threshold meet under some hash function with
probability 1 - (1 - threshold) ** HASHES (a miss in 390,000 pairs); more
similar ones meet more surely, and what meets is compared exactly.

Passages pair across texts only, never within one. Rows with equal texts
are copies, and all their passages repeat. Null texts, and those of fewer
words than a passage, have none. Equal texts get equal results, so null and
repeated ids need no care.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.llm.common import flat_text, row_pieces, starts_to_index, written
from clickweir.llm.suffix_dedup import merged, repeat_runs
from clickweir.llm.words import BASE, find_words, mix, powers, shingle_hashes
from clickweir.llm.words import WORDS as WORD_BYTES

WORDS = 50
SIZE = 5
THRESHOLD = 0.8
HASHES = 8
BLOCK = 2048
TOGETHER = 4096  # windows of small tiles verified at once
STARTS_AT_ONCE = 1 << 15
ENTRIES_AT_ONCE = 1 << 20
CELLS_AT_ONCE = 1 << 20
MARKS = 1024  # bits of a window's shingles
PLACE_BITS = np.uint64(21)
PIECE = 1 << 19
BUCKET_BITS = 10  # of a shingle's hash; those of a bucket are looked up together
SPAN_BITS = 16  # shingles of a piece whose places go in two bytes
SORTED_AT_ONCE = 1 << 22
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
DOWN = np.uint64(pow(int(BASE), -1, 1 << 64))
SALTS = np.random.default_rng(5).integers(1, 1 << 62, 64, dtype=np.int64).astype(np.uint64)


def _nearest_smaller(values: np.ndarray, rows: np.ndarray, step: int) -> np.ndarray:
    """Index of the nearest smaller value before (``step`` -1) or after (1)
    each one, in its own row; -1 or len(values) if there is none. All jump
    at once, over what the values jumped to have already skipped."""
    n = len(values)
    jump = np.arange(n) + step
    end = -1 if step < 0 else n
    live = np.arange(n)
    while len(live):
        to = jump[live]
        real = (to >= 0) & (to < n)
        live, to = live[real], to[real]
        other = rows[to] != rows[live]
        jump[live[other]] = end
        more = ~other & (values[to] >= values[live])
        live = live[more]
        jump[live] = jump[jump[live]]
    return jump


def compact_windows(tokens: np.ndarray, offsets: np.ndarray, width: int, salt: np.uint64):
    """Compact windows of at least ``width`` tokens of rows of tokens: (row,
    l, c, r, hash), places within ``tokens``. These are the nodes of each
    row's Cartesian tree that span ``width`` tokens; the leftmost of equal
    hashes is the parent."""
    n = len(tokens)
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none, none, none.view(np.uint64)
    hashed = mix(tokens ^ salt)
    places = np.arange(n)
    packed = (hashed >> PLACE_BITS << PLACE_BITS) | places.astype(np.uint64)
    # a node spans the width if and only if it is the least of such a run
    wide = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    wide[:n] = packed
    wide = wide.reshape(-1, width)
    ahead = np.minimum.accumulate(wide, axis=1).ravel()
    behind = np.minimum.accumulate(wide[:, ::-1], axis=1)[:, ::-1].ravel()
    runs = n - width + 1
    least = np.minimum(behind[:runs], ahead[width - 1 : width - 1 + runs])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    least = least[row[:runs] == row[width - 1 :]]
    c = np.unique((least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64))
    own = row[c]
    before, after = _nearest_smaller(packed[c], own, -1), _nearest_smaller(packed[c], own, 1)
    left = np.where(before < 0, offsets[own], c[before] + 1)
    right = np.where(after >= len(c), offsets[own + 1] - 1, c[np.minimum(after, len(c) - 1)] - 1)
    return own, left, c, right, hashed[c]


def _cuts(data: np.ndarray, words: int, limit: int):
    """(first word, bytes) of cuts of a long row of about ``limit`` bytes, more
    where they hold too few words. Each begins ``words`` - 1 words before the
    end of the one before it, so every passage lies in one of them."""
    at, base, reach = 0, 0, limit
    while True:
        end = min(at + reach, len(data))
        if end < len(data):  # back to where no word is cut
            gaps = np.flatnonzero(WORD_BYTES[data[at:end]] == 0)
            end = at + int(gaps[-1]) if len(gaps) else at
        begin, _, _, _ = find_words(data[at:end], np.array([0, end - at]))
        if end < len(data) and len(begin) < words:
            reach *= 2
            continue
        yield base, data[at:end]
        if end == len(data):
            return
        base += len(begin) - words + 1
        at += int(begin[len(begin) - words + 1]) if words > 1 else end - at
        reach = limit


def _pieces(data: np.ndarray, offsets: np.ndarray, words: int, limit: int):
    """(first row, word it begins with, bytes, offsets): runs of whole rows, or
    overlapping cuts of one long row."""
    for i, j in row_pieces(offsets, limit):
        part = data[offsets[i] : offsets[j]]
        if len(part) <= limit:
            yield i, 0, part, offsets[i : j + 1] - offsets[i]
        else:
            for base, cut in _cuts(part, words, limit):
                yield i, base, cut, np.array([0, len(cut)])


def _windows(data: np.ndarray, offsets: np.ndarray, words: int, size: int, hashes: int):
    """All windows of the rows of a flat byte array, per hash function, as
    runs of passage starts: (value, content, row, first start, first start of
    the last of equal windows, starts, lead)."""
    _, _, found, counts = find_words(data, offsets)
    width = words - size + 1
    ends = np.concatenate([[0], np.cumsum(counts)])
    tokens = shingle_hashes(found, size)
    # a row's shingles begin where its words do; those over its end are left out
    per = np.maximum(counts - size + 1, 0)
    at = starts_to_index(ends[:-1], per)
    tokens = tokens[at] if len(at) else tokens[:0]
    off = np.concatenate([[0], np.cumsum(per)])
    n = len(tokens)
    down = np.full(n + 1, DOWN, np.uint64)
    down[0] = 1
    down = np.cumprod(down)
    total = np.zeros(n + 1, np.uint64)
    total[1:] = np.cumsum(tokens * powers(n + 1)[:n])
    for f in range(hashes):
        row, left, c, right, value = compact_windows(tokens, off, width, SALTS[f])
        first = np.maximum(left, c - width + 1)
        last = np.minimum(c, right - width + 1)
        content = mix((total[last + width] - total[first]) * down[first] ^ ((c - first).astype(np.uint64) << np.uint64(32)) ^ (last - first).astype(np.uint64))
        # equal windows that follow one another, as in periodic text, are one run
        head, times = repeat_runs(row, first, last, content)
        reach = first[head + times - 1]
        row, first, last, c, value, content = (x[head] for x in (row, first, last, c, value, content))
        yield mix(value ^ SALTS[f + 32]), content, row, first - off[row], reach - off[row], last - first + 1, c - first


def _binary(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary values of so many entries each, one after the other."""
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts * data.itemsize, out=ends[1:])
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _entries(col, kind) -> tuple[np.ndarray, np.ndarray]:
    """(entries, how many each value has) of what ``_binary`` made."""
    data, off = flat_text(col)
    return data.view(kind), np.diff(off) // np.dtype(kind).itemsize


def lacking(width: int, part: int) -> tuple[int, int]:
    """How many of its shingles the near duplicate of a passage of ``width``
    shingles can lack: if neither has two that repeat, and at all."""

    def most(least: int) -> int:
        sizes = range(max(least, 1), width + 1)
        common = ((a, b, -(-part * (a + b) // (1000 + part))) for a in sizes for b in sizes)
        return max(a - c for a, b, c in common if c <= min(a, b))

    return most(width - 1), most(1)


def repetitive(tokens: np.ndarray, tops: np.ndarray, passages: np.ndarray, width: int) -> np.ndarray:
    """Tokens that lie in a passage in which, by 16 bits of them, two tokens or
    more stand for another time. ``tops``: where rows begin, ``passages``: how
    many each has."""
    short = (tokens >> np.uint64(7)).astype(np.uint16)
    again = np.zeros(len(tokens), bool)
    for k in range(1, width):
        again[k:] |= short[k:] == short[:-k]
    before = np.concatenate([[0], np.cumsum(again)])
    start = starts_to_index(tops, passages)
    start = start[before[start + width] - before[start] > 1]
    edge = np.bincount(start, minlength=len(tokens) + 1) - np.bincount(start + width, minlength=len(tokens) + 1)
    return np.cumsum(edge)[: len(tokens)] > 0


SHINGLES = "bucket int, piece long, span int, hashes binary, places binary"
SHINGLE_NAMES = [c.split()[0] for c in SHINGLES.split(", ")]


def _shingle_rows(words: int, size: int):
    """The shingles of texts that have passages: of each piece of texts a row for
    each bucket and span, with 31 bits of each hash, a bit for repetitive text,
    and its place in the span. A row of span -1 has the piece's texts; its
    bucket is one that no shingle has."""
    width = words - size + 1

    def rows(batches):
        for batch in batches:
            data, off = flat_text(batch.column("text"))
            keys, ids = (batch.column(n).to_numpy() for n in ("key", "id"))
            for i, base, part, ends in _pieces(data, off, words, 2 * PIECE):
                _, _, found, counts = find_words(part, ends)
                own = np.flatnonzero(counts >= words)
                if not len(own):
                    continue
                per = counts[own] - size + 1
                tokens = shingle_hashes(found, size)[starts_to_index((np.cumsum(counts) - counts)[own], per)]
                hashes = (tokens >> np.uint64(16)).astype(np.uint32) & np.uint32(0xFFFFFFFE)
                hashes |= repetitive(tokens, np.cumsum(per) - per, per - width + 1, width)
                key, who = keys[i + own], ids[i + own]
                # the same for the same texts, whenever the task runs
                piece = mix(np.bitwise_xor.reduce(mix(key.view(np.uint64) + np.arange(len(key), dtype=np.uint64) * BASE)).reshape(1) + np.uint64(base)).view(np.int64)
                head = [(1 << BUCKET_BITS) + int(piece[0] & 0xFFFF)], piece, [-1], [np.concatenate([key, who]).tobytes()], [np.concatenate([[base], per]).astype(np.int64).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(head, (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=SHINGLE_NAMES)
                buckets = (tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16)
                for span, a in enumerate(range(0, len(tokens), 1 << SPAN_BITS)):
                    some = buckets[a : a + (1 << SPAN_BITS)]
                    by = np.argsort(some, kind="stable")
                    often = np.bincount(some)
                    there = np.flatnonzero(often)
                    often = often[there]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(there.astype(np.int32)), pa.array(np.repeat(piece, len(there))), pa.array(np.full(len(there), span, np.int32)),
                            _binary(hashes[a + by], often), _binary(by.astype(np.uint16), often),
                        ],
                        names=SHINGLE_NAMES,
                    )

    return rows


PLACES = "piece long, span int, entries int, places binary, loose binary"
PLACE_NAMES = [c.split()[0] for c in PLACES.split(", ")]


def met_twice(codes: np.ndarray, loose: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Entries whose code others have as well, those among them of which any
    of the code is ``loose``.)"""
    twice, some = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
    parts = -(-len(codes) // SORTED_AT_ONCE)
    part = (codes % np.uint64(parts)).astype(np.int32) if parts > 1 else np.zeros(len(codes), np.int32)
    for k in range(parts):
        at = np.flatnonzero(part == k) if parts > 1 else np.arange(len(codes))
        at = at[np.argsort(codes[at])]
        new = np.concatenate([[True], codes[at[1:]] != codes[at[:-1]]])
        more = ~(new & np.append(new[1:], True))
        twice[at] = more
        if loose[at].any():
            group = np.cumsum(new) - 1
            some[at] = more & (np.bincount(group, loose[at]) > 0)[group]
    return twice, some


def _shared_places(batches):
    """Of rows sorted by bucket, the places of shingles that are met twice."""

    def looked_up(table: pa.Table):
        bucket, span = (table.column(n).to_numpy() for n in ("bucket", "span"))
        entry = bucket < 1 << BUCKET_BITS
        texts = table.filter(pa.array(~entry))
        if texts.num_rows:
            yield pa.RecordBatch.from_arrays(
                [*(texts.column(n).combine_chunks() for n in ("piece", "span")), pa.array(np.zeros(texts.num_rows, np.int32)), *(texts.column(n).combine_chunks() for n in ("hashes", "places"))],
                names=PLACE_NAMES,
            )
            table, bucket, span = table.filter(pa.array(entry)), bucket[entry], span[entry]
        if not table.num_rows:
            return
        hashes, often = _entries(table.column("hashes"), np.uint32)
        places, _ = _entries(table.column("places"), np.uint16)
        row = np.repeat(np.arange(len(often)), often)
        twice, loose = met_twice((bucket.astype(np.uint64) << np.uint64(31))[row] | (hashes >> np.uint32(1)), (hashes & np.uint32(1)) > 0)
        yield pa.RecordBatch.from_arrays(
            [
                table.column("piece").combine_chunks(), pa.array(span), pa.array(often.astype(np.int32)),
                *(_binary(places[x], np.bincount(row[x], minlength=len(often))) for x in (twice, loose)),
            ],
            names=PLACE_NAMES,
        )

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < 8 * PIECE:
            continue
        table = pa.Table.from_batches(held)
        bucket = table.column("bucket").to_numpy()
        done = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
        if done:
            yield from looked_up(table.slice(0, done))
            held = table.slice(done).to_batches()
            size = sum(x.nbytes for x in held)
    if held:
        yield from looked_up(pa.Table.from_batches(held))


HOPEFUL = "key long, id long, first long, last long"


def _hopeful(words: int, size: int, threshold: float):
    """Of rows sorted by piece, the runs of starts of the passages that can have
    a near duplicate. A shingle that is not met twice is one of its passage."""
    width = words - size + 1
    few, most = lacking(width, round(1000 * threshold))

    def runs(rows: pa.Table):
        span, entries = (rows.column(n).to_numpy() for n in ("span", "entries"))
        texts = np.flatnonzero(span < 0)
        who = np.frombuffer(rows.column("places")[int(texts[0])].as_buffer(), np.int64).reshape(2, -1) if len(texts) else np.zeros((2, 0), np.int64)
        base, *per = np.frombuffer(rows.column("loose")[int(texts[0])].as_buffer(), np.int64).tolist() if len(texts) else [0]
        per = np.array(per, np.int64)
        n = int(per.sum())
        if entries.sum() != n * len(texts):
            raise RuntimeError("shingles of a piece of texts are lost: the texts came in another order when a task ran again")
        rows = rows.filter(pa.array(span >= 0))
        span = span[span >= 0].astype(np.int64) << SPAN_BITS
        counted = []
        for name in ("places", "loose"):
            places, often = _entries(rows.column(name), np.uint16)
            there = np.zeros(n, bool)
            there[np.repeat(span, often) + places] = True
            counted.append(np.concatenate([[0], np.cumsum(there)]))
        passages = per - width + 1
        row = np.repeat(np.arange(len(per)), passages)
        start = starts_to_index(np.cumsum(per) - per, passages)
        lacks, loose = (c[start + width] - c[start] for c in counted)
        lacks = width - lacks
        hopeful = (lacks <= few) | ((lacks <= most) & (loose > 0))
        start, row = start[hopeful], row[hopeful]
        if not len(start):
            return
        new = np.concatenate([[True], (np.diff(start) != 1) | (np.diff(row) != 0)])
        a, b = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(start)) - 1
        top = (np.cumsum(per) - per)[row[a]] - base
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (who[0][row[a]], who[1][row[a]], start[a] - top, start[b] - top)], names=[c.split()[0] for c in HOPEFUL.split(", ")])

    def run(batches):
        held = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            piece = table.column("piece").to_numpy()
            heads = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]])).tolist() if len(piece) else []
            for a, b in zip(heads, heads[1:], strict=False):
                yield from runs(table.slice(a, b - a))
            held = table.slice(heads[-1]).to_batches() if heads else []
        if held:
            yield from runs(pa.Table.from_batches(held))

    return run


REGIONS = "key long, firsts array<long>, raws array<binary>"


def _cut_regions(words: int):
    """The words of the hopeful runs of each text, as bytes, and their starts."""

    def rows(batches):
        for batch in batches:
            data, off = flat_text(batch.column("text"))
            raw = data.tobytes()
            lists = batch.column("runs")
            top, runs = lists.offsets.to_numpy(), lists.values
            first, last = (runs.field(runs.type.get_field_index(n)).to_numpy() for n in ("first", "last"))
            for i, j in row_pieces(off, PIECE):
                begin, length, _, counts = find_words(data[off[i] : off[j]], off[i : j + 1] - off[i])
                ends = np.cumsum(counts) - counts
                firsts, raws = [], []
                for k in range(i, j):
                    a, b = merged(first[top[k] : top[k + 1]], last[top[k] : top[k + 1]] + 1)
                    head, tail = ends[k - i] + a, ends[k - i] + b + words - 2
                    firsts.append(a)
                    raws.append([raw[x:y] for x, y in zip((off[i] + begin[head]).tolist(), (off[i] + begin[tail] + length[tail]).tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(i, j - i), pa.array(firsts, pa.list_(pa.int64())), pa.array(raws, pa.list_(pa.binary()))], names=["key", "firsts", "raws"])

    return rows


def _region_rows(batches):
    """Each region as a text of its own."""
    for batch in batches:
        raws = batch.column("raws")
        own = np.repeat(batch.column("key").to_numpy(), np.diff(raws.offsets.to_numpy()))
        yield pa.RecordBatch.from_arrays([pa.array(own), batch.column("firsts").flatten(), raws.flatten()], names=["key", "first", "text"])


WINDOWS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("value", "content", "key")]
    + [T.StructField("start", T.LongType()), T.StructField("reach", T.LongType()), T.StructField("starts", T.IntegerType()), T.StructField("lead", T.IntegerType())]
)


def _window_rows(words: int, size: int, hashes: int):
    """``first``, if there: the place of the text's first word in a longer one."""

    def rows(batches):
        for batch in batches:
            data, off = flat_text(batch.column("text"))
            keys = batch.column("key").to_numpy()
            firsts = batch.column("first").to_numpy() if "first" in batch.schema.names else np.zeros(len(keys), np.int64)
            # fewer bytes, and so fewer shingles, than there are places
            for i, base, part, ends in _pieces(data, off, words, min(PIECE, 1 << int(PLACE_BITS))):
                for value, content, row, start, reach, starts, lead in _windows(part, ends, words, size, hashes):
                    start, reach = (firsts[i + row] + base + x for x in (start, reach))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(value.view(np.int64)), pa.array(content.view(np.int64)), pa.array(keys[i + row]),
                            pa.array(start), pa.array(reach), pa.array(starts.astype(np.int32)), pa.array(lead.astype(np.int32)),
                        ],
                        names=WINDOWS.names,
                    )

    return rows


def _in_several_texts(batches):
    """Windows whose value several texts have, of rows sorted by value. Those
    of a value wait until a second text has it, so what waits is of one text."""
    waiting, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*waiting, batch]).combine_chunks()
        value, key = rows.column("value").to_numpy(), rows.column("key").to_numpy()
        head = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        several = np.minimum.reduceat(key, head) != np.maximum.reduceat(key, head)
        if last is not None and value[0] == last:
            several[0] = True
        out = np.repeat(several, np.diff(np.append(head, len(value))))
        if out.any():
            yield from rows.filter(pa.array(out)).to_batches()
        last, waiting = (value[-1], []) if several[-1] else (None, rows.slice(int(head[-1])))
        if len(waiting):  # copies of a text repeat its rows
            waiting = waiting.group_by(rows.column_names).aggregate([]).select(rows.column_names).to_batches()


MEMBER = "value long, content long, key long, many boolean, starts int, lead int, block int, blocks int, raw binary"
MEMBER_NAMES = [c.split()[0] for c in MEMBER.split(", ")]


def _cut_windows(words: int):
    """The words of the wanted windows of each text, as bytes, from its regions."""

    def rows(batches):
        for batch in batches:
            data, off = flat_text(batch.column("raws").flatten())
            raw = data.tobytes()
            texts = np.arange(batch.num_rows, dtype=np.int64) << 40  # more than a text has words
            first = batch.column("firsts").flatten().to_numpy()
            lists = batch.column("wanted")
            wanted = lists.flatten()
            col = {wanted.type.field(k).name: wanted.field(k) for k in range(wanted.type.num_fields)}
            start, starts = col["start"].to_numpy(), col["starts"].to_numpy()
            place = np.repeat(texts, np.diff(batch.column("raws").offsets.to_numpy())) + first
            region = np.searchsorted(place, np.repeat(texts, np.diff(lists.offsets.to_numpy())) + start, side="right") - 1
            by = np.argsort(region, kind="stable")
            for i, j in row_pieces(off, PIECE):
                begin, length, _, counts = find_words(data[off[i] : off[j]], off[i : j + 1] - off[i])
                ends = np.cumsum(counts) - counts
                low, high = np.searchsorted(region[by], [i, j]).tolist()
                for a in range(low, high, 4096):
                    some = by[a : min(a + 4096, high)]
                    own = region[some]
                    head = ends[own - i] + start[some] - first[own]
                    tail = head + starts[some] + words - 2
                    cut = [raw[x:y] for x, y in zip((off[i] + begin[head]).tolist(), (off[i] + begin[tail] + length[tail]).tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([*(col[n].take(pa.array(some)) for n in MEMBER_NAMES[:-1]), pa.array(cut, pa.binary())], names=MEMBER_NAMES)

    return rows


class Members:
    """Windows that may pair with others of their tile: their shingles as small
    ids, the starts of passages that hold each of them, and which passages
    have a near duplicate; ``found``: windows all of whose passages are known
    to have one."""

    def __init__(self, ids: np.ndarray, kinds: int, order: np.ndarray, offsets: np.ndarray, starts: np.ndarray, lead: np.ndarray, width: int, part: int, found: np.ndarray, tile: np.ndarray, side: np.ndarray, keys: np.ndarray, many: np.ndarray):
        self.ids, self.kinds, self.order = ids, kinds, order  # entries by shingle and place
        self.off, self.starts, self.lead, self.width, self.part = offsets, starts, lead, width, part
        self.tile, self.side, self.keys, self.many = tile, side, keys, many
        n, windows = len(self.ids), len(starts)
        self.row = np.repeat(np.arange(len(starts)), np.diff(offsets))
        place = np.arange(n) - offsets[self.row]
        self.code = ids[order] * windows + self.row[order]
        # place of the same shingle just before in its window, -1 if none
        earlier = np.full(n, -1)
        same = self.code[1:] == self.code[:-1]
        earlier[self.order[1:][same]] = place[self.order[:-1][same]]
        self.once = earlier < 0
        # starts of passages in which a shingle stands first of its equals
        self.low = np.maximum(earlier + 1, place - width + 1)
        self.high = np.minimum(place, starts[self.row] - 1)
        self.real = self.low <= self.high
        # one cell a passage and a spare one a window
        self.first = np.cumsum(starts + 1) - starts - 1
        self.cells = int((starts + 1).sum())
        self.spare = np.zeros(self.cells, bool)
        self.spare[self.first + starts] = True
        self.owner = np.repeat(np.arange(len(starts)), starts + 1)
        self.distinct = self.covered(np.flatnonzero(self.real))  # distinct shingles of each passage
        # what two near duplicates have in common is at least this part of either
        self.need = -(-part * self.distinct // 1000)
        self.need[self.spare] = 1 << 30
        self.least = np.minimum.reduceat(self.need, self.first) if len(starts) else self.need
        self.found = np.repeat(found, starts + 1) & ~self.spare
        self.live = ~self.spare  # passages that may have a near duplicate in the tile

    def covered(self, entries: np.ndarray) -> np.ndarray:
        """How many of the entries lie in each passage, by cell."""
        base = self.first[self.row[entries]]
        up = np.bincount(base + self.low[entries], minlength=self.cells)
        down = np.bincount(base + self.high[entries] + 1, minlength=self.cells)
        return np.cumsum(up - down)

    def narrow(self) -> None:
        """Leave out passages that share too little with all windows they may
        pair with, taken together, and so on with the windows left."""
        alive = np.ones(len(self.starts), bool)
        firsts = np.flatnonzero(self.once)
        row, ids = self.row[firsts], self.ids[firsts]
        while True:
            on = alive[row]
            # a window of one block pairs with the other block's, or with its own block's in a tile of one
            seen = [np.bincount(ids[on & (self.side[row] == k)], minlength=self.kinds) for k in range(3)]
            partners = np.stack([seen[0] - 1, seen[2], seen[1]]) > 0
            entries = np.flatnonzero(self.real & alive[self.row])
            entries = entries[partners[self.side[self.row[entries]], self.ids[entries]]]
            live = self.live & (self.covered(entries) >= self.need)
            now = np.logical_or.reduceat(live, self.first)
            self.raise_need(live)
            stable = now.sum() == alive.sum()
            alive, self.live = now, live
            if stable:
                return

    def raise_need(self, live: np.ndarray) -> None:
        """Two passages of a and b shingles have part * (a + b) / (1000 + part)
        in common, and no passage that is left in the tile has fewer than b."""
        self.fewest = np.minimum.reduceat(np.where(live, self.distinct, self.width), self.first)
        fewest = np.full(int(self.tile.max()) + 1, self.width)
        np.minimum.at(fewest, self.tile[self.owner[live]], self.distinct[live])
        least = -(-self.part * (self.distinct + fewest[self.tile[self.owner]]) // (1000 + self.part))
        self.need = np.maximum(self.need, least)
        self.least = np.minimum.reduceat(self.need, self.first)

    def open(self) -> np.ndarray:
        return self.live & ~self.found

    def pairing(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs of windows that are to be compared at all."""
        a, b = self.side[i], self.side[j]
        across = (self.keys[i] != self.keys[j]) | self.many[i] | self.many[j]
        return (i != j) & across & (self.tile[i] == self.tile[j]) & ((a + b == 3) | ((a == 0) & (b == 0)))

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of windows that follow one another in the list of a shingle."""
        firsts = self.order[self.once[self.order]]
        ids, row = self.ids[firsts], self.row[firsts]
        near = ids[1:] == ids[:-1]
        return self.unlike(row[:-1][near], row[1:][near])

    def unlike(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.starts)
        i, j = np.minimum(i, j), np.maximum(i, j)
        pair = np.unique(i * n + j)
        i, j = pair // n, pair % n
        ok = self.pairing(i, j)
        return i[ok], j[ok]

    def candidates(self):
        """Pairs (i, j), some at a time, that hold all near duplicates of
        passages still open: of the shingles of a passage, the rarest first,
        one of the first few must be in the other window."""
        firsts = self.order[self.once[self.order]]
        hopeful = np.logical_or.reduceat(self.live, self.first)
        firsts = firsts[hopeful[self.row[firsts]]]
        often = np.bincount(self.ids[firsts], minlength=self.kinds)
        by_rank = np.argsort(often, kind="stable")
        rank = np.empty(self.kinds, np.int64)
        rank[by_rank] = np.arange(self.kinds)
        rows = self.row[firsts]  # windows of each shingle
        top = np.cumsum(often) - often
        wanted = np.flatnonzero(self.open())
        for a in range(0, len(wanted), STARTS_AT_ONCE):
            cells = wanted[a : a + STARTS_AT_ONCE]
            cells = cells[self.open()[cells]]
            own = self.owner[cells]
            at = (self.off[own] + cells - self.first[own])[:, None] + np.arange(self.width)
            # repeated shingles of a passage count once
            start = (cells - self.first[own])[:, None]
            ranks = np.where((self.low[at] <= start) & (start <= self.high[at]), rank[self.ids[at]], self.kinds)
            ranks.sort(axis=1)
            early = np.arange(self.width) <= (self.distinct[cells] - self.need[cells])[:, None]
            code = np.unique((own[:, None] * (self.kinds + 1) + ranks)[early & (ranks < self.kinds)])
            shingle = by_rank[code % (self.kinds + 1)]
            code, shingle = code[often[shingle] > 1], shingle[often[shingle] > 1]
            own = code // (self.kinds + 1)
            size = np.cumsum(often[shingle])
            x = 0
            while x < len(own):
                y = max(x + 1, int(np.searchsorted(size, (size[x - 1] if x else 0) + ENTRIES_AT_ONCE, side="right")))
                j = rows[starts_to_index(top[shingle[x:y]], often[shingle[x:y]])]
                yield self.unlike(np.repeat(own[x:y], often[shingle[x:y]]), j)
                x = y

    def compare(self, i: np.ndarray, j: np.ndarray, shift: int | None) -> None:
        """Mark the passages of the windows ``i`` and ``j``, pair by pair, that
        are near duplicates of each other, whatever the offset (or at most
        ``shift``)."""
        most = max(1, ENTRIES_AT_ONCE // (2 * int(np.diff(self.off).max())))
        # a few pairs of every window first: those settle many that then need no more
        by = np.random.default_rng(len(i)).permutation(len(i))
        step, a = min(most, max(512, len(self.starts) // 2)), 0
        while a < len(by):
            open_ = np.logical_or.reduceat(self.open(), self.first)
            p, q = i[by[a : a + step]], j[by[a : a + step]]
            unsettled = open_[p] | open_[q]
            p, q = p[unsettled], q[unsettled]
            if len(p):
                self._compare(p, q, shift)
            a, step = a + step, min(2 * step, most)

    def _shared(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair, entry): entries of the windows ``i`` that stand, by a few bits
        of their shingle, in the windows ``j`` as well."""
        size = self.off[i + 1] - self.off[i]
        entry = starts_to_index(self.off[i], size)
        pair = np.repeat(np.arange(len(i)), size)
        if not hasattr(self, "bits"):
            self.bits = np.zeros((len(self.starts), MARKS), bool)
            self.bits[self.row, self.ids % MARKS] = True
            self.bits = self.bits.reshape(-1)
        hit = self.bits[(j * MARKS)[pair] + self.ids[entry] % MARKS] & self.real[entry]
        return pair[hit], entry[hit]

    def _reach(self, i: np.ndarray, j: np.ndarray, pair: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Passages of the windows ``i`` that hold enough of the entries of
        their pair, for any passage of the windows ``j``: (pair, cell, entries held)."""
        wide = self.starts[i] + 1
        top = np.cumsum(wide) - wide
        total = int(wide.sum())
        up = np.bincount(top[pair] + self.low[entry], minlength=total)
        down = np.bincount(top[pair] + self.high[entry] + 1, minlength=total)
        cell = starts_to_index(self.first[i], wide)
        common = np.cumsum(up - down)
        enough = np.flatnonzero((common >= self.need[cell]) & self.live[cell])
        fewest = self.fewest[j][np.repeat(np.arange(len(i)), wide)[enough]]
        enough = enough[(1000 + self.part) * common[enough] >= self.part * (self.distinct[cell[enough]] + fewest)]
        return np.repeat(np.arange(len(i)), wide)[enough], cell[enough], common[enough]

    def _compare(self, i: np.ndarray, j: np.ndarray, shift: int | None) -> None:
        for _ in range(2):  # windows that share too little, from either side
            pair, entry = self._shared(i, j)
            keep = np.bincount(pair, minlength=len(i)) >= np.maximum(self.least[i], self.least[j])
            pair_i, _, _ = self._reach(i, j, pair, entry)
            keep &= np.bincount(pair_i, minlength=len(i)) > 0
            i, j = j[keep], i[keep]
            if not len(i):
                return
        pairs = [self._reach(x, y, *self._shared(x, y)) for x, y in ((i, j), (j, i))]
        n = len(i)
        # what is held must be enough for the smallest passage left on the other side
        fewest = [np.full(n, 1 << 30) for _ in pairs]
        for low, (pair, cell, _) in zip(fewest, pairs, strict=True):
            np.minimum.at(low, pair, self.distinct[cell])
        pairs = [
            tuple(x[(1000 + self.part) * common >= self.part * (self.distinct[cell] + low[pair])] for x in (pair, cell))
            for low, (pair, cell, common) in zip(fewest[::-1], pairs, strict=True)
        ]
        some = [np.bincount(pair[~self.found[cell]], minlength=n) > 0 for pair, cell in pairs]
        keep = some[0] | some[1]
        lows, highs = [], []
        for (pair, cell), x in zip(pairs, (i, j), strict=True):
            low, high = np.full(n, 1 << 30), np.full(n, -1)
            place = cell - self.first[x[pair]]
            np.minimum.at(low, pair, place)
            np.maximum.at(high, pair, place)
            keep &= high >= 0
            lows.append(low)
            highs.append(high + 1)
        i, j, s0, s1, t0, t1 = (x[keep] for x in (i, j, lows[0], highs[0], lows[1], highs[1]))
        area = (s1 - s0 + 1) * (t1 - t0 + 1)
        by = np.argsort((s1 - s0) * 1024 + t1 - t0, kind="stable")
        a = 0
        while a < len(by):  # tables of like shape together
            b = a + max(1, min(len(by) - a, CELLS_AT_ONCE // int(area[by[a:]].max())))
            self._table(*(x[by[a:b]] for x in (i, j, s0, s1, t0, t1)), shift)
            a = b

    def _table(self, i, j, s0, s1, t0, t1, shift: int | None) -> None:
        """Count the shingles that the passages s0..s1 of windows ``i`` and
        t0..t1 of ``j`` have in common, for each pair of passages."""
        size = self.off[j + 1] - self.off[j]
        y = starts_to_index(self.off[j], size)
        pair = np.repeat(np.arange(len(i)), size)
        use = self.real[y] & (self.low[y] < t1[pair]) & (self.high[y] >= t0[pair])
        y, pair = y[use], pair[use]
        code = self.ids[y] * len(self.starts) + i[pair]
        lo = np.searchsorted(self.code, code)
        hi = np.searchsorted(self.code, code, side="right")
        fan = hi - lo
        x = self.order[starts_to_index(lo, fan)]
        y, pair = np.repeat(y, fan), np.repeat(pair, fan)
        # a shingle in common counts for a rectangle of pairs of starts
        a0, a1 = np.maximum(self.low[x], s0[pair]) - s0[pair], np.minimum(self.high[x] + 1, s1[pair]) - s0[pair]
        b0, b1 = np.maximum(self.low[y], t0[pair]) - t0[pair], np.minimum(self.high[y] + 1, t1[pair]) - t0[pair]
        ok = (a0 < a1) & (b0 < b1)
        pair, a0, a1, b0, b1 = pair[ok], a0[ok], a1[ok], b0[ok], b1[ok]
        n_a, n_b = int((s1 - s0).max()), int((t1 - t0).max())
        common = np.zeros((len(i), n_a + 1, n_b + 1), np.int32)
        flat = common.reshape(-1)
        base = pair * ((n_a + 1) * (n_b + 1))
        for s, t, sign in ((a0, b0, 1), (a1, b1, 1), (a0, b1, -1), (a1, b0, -1)):
            np.add.at(flat, base + s * (n_b + 1) + t, np.int32(sign))
        np.cumsum(common, axis=1, out=common)
        np.cumsum(common, axis=2, out=common)
        common = common[:, :n_a, :n_b]
        s, t = np.arange(n_a), np.arange(n_b)
        mine = self.first[i][:, None] + np.minimum(s0[:, None] + s, self.starts[i][:, None] - 1)
        theirs = self.first[j][:, None] + np.minimum(t0[:, None] + t, self.starts[j][:, None] - 1)
        total = self.distinct[mine].astype(np.int32)[:, :, None] + self.distinct[theirs].astype(np.int32)[:, None, :]
        near = np.int32(1000 + self.part) * common >= np.int32(self.part) * total
        near &= (s < (s1 - s0)[:, None])[:, :, None]
        near &= (t < (t1 - t0)[:, None])[:, None, :]
        if shift is not None:
            near &= np.abs((t + (t0 - self.lead[j])[:, None])[:, None, :] - (s + (s0 - self.lead[i])[:, None])[:, :, None]) <= shift
        self.found[mine[near.any(axis=2)]] = True
        self.found[theirs[near.any(axis=1)]] = True


def in_order(tokens: np.ndarray) -> np.ndarray:
    """Stable order of 64-bit tokens, by one sort of their upper bits and places."""
    bits = np.uint64(max(1, len(tokens).bit_length()))
    order = (np.sort((tokens >> bits << bits) | np.arange(len(tokens), dtype=np.uint64)) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    by = tokens[order]
    return order if (by[1:] >= by[:-1]).all() else np.argsort(tokens, kind="stable")


def verify_tile(raws: list[bytes], keys, many, starts, lead, left, right, words: int, size: int, threshold: float, shift: int | None = None) -> list[tuple[int, int, int]]:
    """Runs (member, first, last start) with a near duplicate in the tile."""
    off = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
    data = np.frombuffer(b"".join(raws), np.uint8)
    side = np.zeros(len(raws), np.int64)
    if not np.array_equal(left, right):
        side[left], side[right] = 1, 2
    found = verify_tiles(data, off, keys, many, starts, lead, np.zeros(len(raws), np.int64), side, words, size, threshold, shift)
    return list(zip(*(x.tolist() for x in found), strict=True))


def verify_tiles(data: np.ndarray, off: np.ndarray, keys, many, starts, lead, tile, side, words: int, size: int, threshold: float, shift: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (member, first, last start) with a near duplicate in their tile;
    ``tile``: each member's, ``side``: 0 in a tile of one block, else 1 or 2
    by the block it is of. Members pair across texts; one that stands for
    several (``many``) repeats from end to end, so it helps to find others but
    is not returned itself. ``shift`` bounds the offset of two passages,
    counted from the shared shingle; None compares all.

    Passages are narrowed down by bounds that hold for every pair, the windows
    that follow one another in the list of a shingle are compared first, as
    they settle most, and then those that share a rare shingle of a passage
    still without a near duplicate."""
    _, _, found, counts = find_words(data, off)
    ends = np.concatenate([[0], np.cumsum(counts)])
    per = counts - size + 1
    tokens = shingle_hashes(found, size)[starts_to_index(ends[:-1], per)]
    tokens = mix(tokens ^ np.repeat(mix(tile.astype(np.uint64) + np.uint64(1)), per))  # shingles meet within a tile
    part, width = round(1000 * threshold), words - size + 1

    order = in_order(tokens)
    new = np.concatenate([[False], np.diff(tokens[order]) != 0])
    ids = np.empty(len(tokens), np.int64)
    ids[order] = np.cumsum(new)
    often = np.bincount(ids)

    def group(rows: np.ndarray) -> Members:
        kept = np.zeros(len(per), bool)
        kept[rows] = True
        kept = np.repeat(kept, per)
        by = (np.cumsum(kept) - 1)[order[kept[order]]]
        return Members(ids[kept], len(often), by, np.concatenate([[0], np.cumsum(per[rows])]), starts[rows], lead[rows], width, part, many[rows], tile[rows], side[rows], keys[rows], many[rows])

    # a passage has too many shingles of its own: no other window has them
    alone = np.concatenate([[0], np.cumsum(often[ids] == 1)])
    begin = starts_to_index(np.cumsum(per) - per, starts)
    few = alone[begin + width] - alone[begin] <= width - -(-part * width // 1000)
    rows = np.flatnonzero(np.logical_or.reduceat(few, np.cumsum(starts) - starts))
    if not len(rows):
        none = np.zeros(0, np.int64)
        return none, none, none
    members = group(rows)
    members.narrow()
    live, cells = np.logical_or.reduceat(members.live, members.first), members.live
    rows = rows[live]
    if not len(rows):
        none = np.zeros(0, np.int64)
        return none, none, none
    kept = cells[live[members.owner]]
    members = group(rows)
    members.live = kept
    members.raise_need(kept)
    members.compare(*members.neighbours(), shift)
    for i, j in members.candidates():
        members.compare(i, j, shift)
    edge = members.found & ~members.many[members.owner]
    change = np.flatnonzero(np.diff(np.concatenate([[0], edge.astype(np.int8), [0]])))
    a, b = change[::2], change[1::2] - 1
    member = members.owner[a]
    return rows[member], a - members.first[member], b - members.first[member]


RUN = "value long, content long, low int, high int"


def _tiles(words: int, size: int, threshold: float, shift: int | None):
    def distinct(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        """Each window of a tile once, and the number of its tile."""
        value, first, second, content, block = (table.column(n).to_numpy() for n in ("value", "tile_a", "tile_b", "content", "block"))
        new = np.concatenate([[True], (np.diff(value) != 0) | (np.diff(first) != 0) | (np.diff(second) != 0)])
        tile = np.cumsum(new) - 1
        by = np.lexsort((block, content, tile))
        again = (np.diff(tile[by]) == 0) & (np.diff(content[by]) == 0) & (np.diff(block[by]) == 0)
        kept = np.sort(by[np.concatenate([[True], ~again])])
        return table.take(kept), tile[kept]

    def verified(table: pa.Table, tile: np.ndarray):
        table = table.combine_chunks()
        col = {n: table.column(n).to_numpy() for n in table.column_names if n != "raw"}
        data, off = flat_text(table.column("raw"))
        side = np.where(col["tile_a"] == col["tile_b"], 0, np.where(col["block"] == col["tile_a"], 1, 2))
        many = col["many"].astype(bool)
        member, low, high = verify_tiles(data, off, col["key"], many, col["starts"].astype(np.int64), col["lead"].astype(np.int64), tile, side, words, size, threshold, shift)
        if len(member):
            yield pa.RecordBatch.from_arrays(
                [pa.array(col["value"][member]), pa.array(col["content"][member]), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
                names=["value", "content", "low", "high"],
            )

    def run(batches):
        held, rows, limit = [], 0, TOGETHER
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < limit:
                continue
            table, tile = distinct(pa.Table.from_batches(held))
            done = int(np.searchsorted(tile, tile[-1]))  # the last tile may go on
            if done:
                yield from verified(table.slice(0, done), tile[:done])
            held = table.slice(done).to_batches()
            rows = table.num_rows - done
            limit = TOGETHER + rows
        if rows:
            yield from verified(*distinct(pa.Table.from_batches(held)))

    return run


def settled(df: DataFrame, name: str) -> DataFrame:
    """``written``; the shuffles it took, which nothing else reads, are removed
    when it is done and do not wait for the driver's garbage collection."""
    conf = df.sparkSession.conf
    was = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return written(df, name)
    finally:
        if was is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, was)


def hopeful_regions(source: DataFrame, words: int, size: int, threshold: float) -> DataFrame:
    """For each text by its ``key``, the runs of words in passages that can have
    a near duplicate, by their shingles: first words and bytes. ``id`` tells
    rows of one key apart; one of them stands for all."""
    shingles = source.mapInArrow(_shingle_rows(words, size), SHINGLES)
    places = shingles.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_shared_places, PLACES)
    hopeful = settled(places.repartition("piece").sortWithinPartitions("piece").mapInArrow(_hopeful(words, size, threshold), HOPEFUL), "passages-hopeful")
    runs = hopeful.groupBy("key").agg(F.min("id").alias("id"), F.collect_set(F.struct("first", "last")).alias("runs"))  # as many as the text has
    return settled(source.join(runs, ["key", "id"]).select("key", "text", "runs").mapInArrow(_cut_regions(words), REGIONS), "passages-regions")


def passage_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, size: int = SIZE, threshold: float = THRESHOLD, hashes: int = HASHES, block: int = BLOCK, shift: int | None = None) -> DataFrame:
    """(key, spans): for each text (by the xxhash64 of it) with near-duplicate
    passages elsewhere, their runs of words as an array of (start, stop)."""
    source = docs.select(F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("key"), F.xxhash64(F.col(doc_id)).alias("id")).filter("text IS NOT NULL")
    regions = hopeful_regions(source, words, size, threshold)
    windows = regions.mapInArrow(lambda batches: _window_rows(words, size, hashes)(_region_rows(batches)), WINDOWS)
    # copies of one text are one text here
    shared = settled(windows.repartition("value").sortWithinPartitions("value").mapInArrow(_in_several_texts, WINDOWS), "passages-shared")
    distinct = settled(
        shared.groupBy("value", "content", "starts", "lead").agg(F.min(F.struct("key", "start")).alias("at"), F.max("key").alias("high")), "passages-distinct"
    )
    sizes = distinct.groupBy("value").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    blocks = F.ceil(F.col("members") / block).cast("int")
    own = distinct.join(sizes, "value").select(
        F.col("at.key").alias("key"),
        F.struct(
            "value", "content", F.col("at.key").alias("key"), (F.col("high") != F.col("at.key")).alias("many"), F.col("at.start").alias("start"), "starts", "lead",
            F.pmod(F.xxhash64("content"), blocks).cast("int").alias("block"), blocks.alias("blocks"),
        ).alias("w"),
    )
    wanted = own.groupBy("key").agg(F.collect_list("w").alias("wanted"))  # as many as the text has windows
    members = regions.join(wanted, "key").select("firsts", "raws", "wanted").mapInArrow(_cut_windows(words), MEMBER)
    tiles = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "value", F.least("block", "other").alias("tile_a"), F.greatest("block", "other").alias("tile_b"), "content", "key", "many", "starts", "lead", "block", "raw"
    )
    near = (
        tiles.repartition("value", "tile_a", "tile_b")
        .sortWithinPartitions("value", "tile_a", "tile_b")
        .mapInArrow(_tiles(words, size, threshold, shift), RUN)
    )
    equal = distinct.filter(F.col("high") != F.col("at.key")).select("value", "content", F.lit(0).alias("low"), (F.col("starts") - 1).alias("high"))
    runs = settled(equal.unionByName(near), "passages-runs")
    spans = (
        shared.join(runs, ["value", "content"])
        # passages of equal windows in a run overlap, so the run is covered as one
        .select("key", (F.col("start") + F.col("low")).alias("start"), (F.col("reach") + F.col("high") + words).alias("stop"))
        .distinct()
    )
    return spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


OUT = ("n_words", "passages")


def _mark(words: int):
    def run(batches):
        for batch in batches:
            data, off = flat_text(batch.column("text"))
            counts = np.zeros(batch.num_rows, np.int64)
            for i, j in row_pieces(off):
                counts[i:j] = find_words(data[off[i] : off[j]], off[i : j + 1] - off[i])[3]
            passages = []
            for n, spans, copies in zip(counts.tolist(), batch.column("spans").to_pylist(), batch.column("copies").to_pylist(), strict=True):
                if copies and copies > 1 and n >= words:
                    passages.append([{"start": 0, "stop": n}])
                elif not spans:
                    passages.append([])
                else:
                    s, e = merged(np.array([x["start"] for x in spans]), np.array([x["stop"] for x in spans]))
                    passages.append([{"start": a, "stop": b} for a, b in zip(s.tolist(), e.tolist(), strict=True)])
            pair = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("d"), pa.array(counts), pa.array(passages, pair)], names=["d", *OUT])

    return run


def near_duplicate_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, **options) -> DataFrame:
    """All columns of ``docs`` plus ``n_words`` and ``passages``: the maximal
    runs of words covered by passages that have a near duplicate in another
    row. Columns of these names are replaced."""
    kept = docs.drop(*OUT)
    runs = passage_runs(kept, text, doc_id, words, **options).select(F.col("key").alias("run_key"), "spans")
    key = F.xxhash64(F.col(text))
    copies = kept.groupBy(key.alias("copy_key")).agg(F.count(F.col(text)).alias("copies")).filter("copies > 1")
    found = copies.join(runs, F.col("copy_key") == F.col("run_key"), "full").select(F.coalesce("copy_key", "run_key").alias("found_key"), "copies", "spans")
    columns = [F.col(f"d.`{c}`") for c in kept.columns]
    keyed = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("d"), key.alias("key"), F.col(text).alias("text"))
    joined = keyed.join(found, (F.col("key") == F.col("found_key")) & F.col("text").isNotNull(), "left")
    pair = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    shape = T.StructType([joined.schema["d"], T.StructField("n_words", T.LongType()), T.StructField("passages", T.ArrayType(pair))])
    return joined.select("d", "text", "spans", "copies").mapInArrow(_mark(words), shape).select(*columns, *OUT)
