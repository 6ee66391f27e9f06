"""Periodic runs of words, found by recompression.

A run is a stretch of words with smallest period q, at least ``MIN_POWER``
periods and ``MIN_LENGTH`` words long, that no neighbouring word extends.

The texts of a piece become one run-length grammar: blocks of one symbol and
pairs of neighbours are replaced by new symbols in turn, level by level.
Which neighbours form a pair follows from their symbols alone, so equal
stretches are parsed alike but for their edges, and the common extension of
two places is found by climbing the levels while both stand at the edge of a
symbol, one step a level, and descending again to the first difference. No
suffix array is built.

A run of period q agrees with itself q words on over at least three periods,
so it holds a place of the grid of step 3q. Each such place whose word recurs q words on
is a candidate; its extensions to both sides are exact, so every run is
found with its whole reach. A stretch found under several periods has the
least of them.

Words are the maximal stretches of bytes other than ASCII white space. Null,
empty and blank texts have no words and no runs. Repeated rows and ids are
rows of their own. A text is held whole in its task, with about a hundred bytes a
word; short ones share a grammar.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.llm.words import mix

MIN_POWER = 4
MIN_LENGTH = 6
PIECE_WORDS = 1 << 16
CANDIDATES = 1 << 20
FEW = 4  # symbols a text may have left on the last level


class Grammar:
    """Levels of a sequence in which negative symbols, each used once, stand
    before and after every text. ``up[k]`` maps places of level k to level
    k + 1, ``first[k]`` places of level k + 1 to the first of their parts;
    ``block[k]`` tells whether those parts are equal symbols or a pair."""

    def __init__(self, sequence: np.ndarray):
        self.symbols = [sequence]
        self.up: list[np.ndarray] = []
        self.first: list[np.ndarray] = []
        self.block: list[bool] = []
        self.names = int(sequence.max(initial=-1)) + 1
        while True:
            borders = np.flatnonzero(self.symbols[-1] < 0)
            if np.diff(borders).max(initial=0) <= FEW + 1:
                return
            self._blocks()
            self._pairs()

    def _level(self, heads: np.ndarray, symbols: np.ndarray, block: bool = False) -> None:
        below = len(self.symbols[-1])
        opens = np.zeros(below, np.int32)
        opens[heads] = 1
        self.up.append(np.cumsum(opens, dtype=np.int32) - np.int32(1))
        self.first.append(np.append(heads, below).astype(np.int32))
        self.symbols.append(symbols)
        self.block.append(block)

    def _named(self, packed: np.ndarray) -> np.ndarray:
        kinds, which = np.unique(packed, return_inverse=True)
        out = which + self.names
        self.names += len(kinds)
        return out

    def _blocks(self) -> None:
        now = self.symbols[-1]
        heads = np.flatnonzero(np.concatenate([[True], now[1:] != now[:-1]]))
        if len(heads) == len(now):
            return
        sizes = np.diff(np.append(heads, len(now)))
        out = now[heads]
        long = sizes > 1
        out[long] = self._named(out[long] << 32 | sizes[long])
        self._level(heads, out, block=True)

    def _pairs(self) -> None:
        now = self.symbols[-1]
        side = mix(now.astype(np.uint64) ^ np.uint64(len(self.symbols) << 40)) >> np.uint64(63)
        left = (side == 0) & (now >= 0)
        right = (side == 1) & (now >= 0)
        opens = left[:-1] & right[1:]
        if not opens.any():
            opens = right[:-1] & left[1:]  # as consistent: all of this level take the other order
        if not opens.any():
            # each text's symbols all fall on one side; another level has other sides
            self._level(np.arange(len(now)), now)
            return
        second = np.concatenate([[False], opens])
        heads = np.flatnonzero(~second)
        out = now[heads]
        pair = np.append(opens, False)[heads]
        at = heads[pair]
        out[pair] = self._named(now[at] << 32 | now[at + 1])
        self._level(heads, out)

    def extension(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """Words that agree from the places ``a`` and ``b`` on, to the right
        (``step`` 1) or to the left (-1), both places included."""
        top = len(self.symbols) - 1
        x, y, live = a.astype(np.int64), b.astype(np.int64), np.arange(len(a))
        out = np.zeros(len(a), np.int64)
        parked: list[tuple] = [(x[:0], y[:0], live[:0])] * (top + 1)

        def common(level, p, q):
            """Symbols that agree from places with equal symbols on, before
            both stand at an edge or differ: the rest of the shorter block."""
            if not self.block[level]:
                return 1
            first, p_up, q_up = self.first[level], self.up[level][p], self.up[level][q]
            if step > 0:
                return np.minimum(first[p_up + 1] - p, first[q_up + 1] - q)
            return np.minimum(p - first[p_up], q - first[q_up]) + 1

        def at_edge(level, place):
            first = self.first[level]
            above = self.up[level][place]
            return first[above] == place if step > 0 else first[above + 1] - 1 == place

        for level in range(top):
            symbols = self.symbols[level]
            edge = at_edge(level, x) & at_edge(level, y)
            inside = np.flatnonzero(~edge & (symbols[x] == symbols[y]))
            if len(inside):
                go = common(level, x[inside], y[inside]) * step
                x[inside] += go
                y[inside] += go
                edge[inside] = at_edge(level, x[inside]) & at_edge(level, y[inside])
            parked[level] = (x[~edge], y[~edge], live[~edge])
            x, y, live = self.up[level][x[edge]].astype(np.int64), self.up[level][y[edge]].astype(np.int64), live[edge]
        while True:
            same = np.flatnonzero(self.symbols[top][x] == self.symbols[top][y])
            if not len(same):
                break
            x[same] += step
            y[same] += step
        for level in range(top - 1, -1, -1):
            first, symbols = self.first[level], self.symbols[level]
            x, y = (first[x], first[y]) if step > 0 else (first[x + 1] - 1, first[y + 1] - 1)
            x, y = x.astype(np.int64), y.astype(np.int64)
            same = np.flatnonzero(symbols[x] == symbols[y])
            if len(same):
                go = common(level, x[same], y[same]) * step
                x[same] += go
                y[same] += go
            px, py, pl = parked[level]
            x, y, live = np.concatenate([x, px]), np.concatenate([y, py]), np.concatenate([live, pl])
        out[live] = (x - a[live]) * step
        return out


def _candidates(base: np.ndarray, sizes: np.ndarray):
    """Grid places (place, period) of texts that begin at ``base`` and have
    ``sizes`` words, in parts of about ``CANDIDATES``."""
    periods = sizes // MIN_POWER
    text = np.repeat(np.arange(len(sizes)), periods)
    q = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    per = (sizes[text] - q - 1) // (q * (MIN_POWER - 1)) + 1
    ends = np.cumsum(per)
    at = 0
    while at < len(q):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CANDIDATES, side="right")))
        n = per[at:stop]
        which = np.repeat(np.arange(at, stop), n)
        k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        yield base[text[which]] + k * q[which] * (MIN_POWER - 1), q[which]
        at = stop


def runs_of(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of the texts, given as arrays
    of word numbers, by text, start and period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.cumsum(sizes + 1) - sizes  # a border before each text
    sequence = np.zeros(int(sizes.sum()) + len(texts) + 1, np.int64)
    borders = np.append(base - 1, len(sequence) - 1)
    sequence[borders] = -1 - np.arange(len(borders))
    for at, words in zip(base.tolist(), texts, strict=True):
        sequence[at : at + len(words)] = words
    found = []
    grammar = None
    for place, q in _candidates(base, sizes):
        again = sequence[place] == sequence[place + q]
        place, q = place[again], q[again]
        if not len(place):
            continue
        grammar = grammar or Grammar(sequence)
        ahead = grammar.extension(place, place + q, 1)
        behind = grammar.extension(place - 1, place + q - 1, -1)
        length = behind + ahead + q
        enough = length >= np.maximum(MIN_LENGTH, MIN_POWER * q)
        found.append(np.stack([(place - behind)[enough], length[enough], q[enough]]))
    start, length, q = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[least], length[least], q[least]
    text = np.searchsorted(base, start, side="right") - 1
    start = start - base[text] if len(start) else start
    order = np.lexsort((q, start, text))
    return text[order], start[order], length[order], q[order]


def collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, q: np.ndarray) -> bytes:
    """The words no run holds after its first period, joined by a space."""
    if not len(start):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, start + q, 1)
    np.add.at(step, start + length, -1)
    keep = np.flatnonzero(np.cumsum(step[:-1]) == 0)
    return b" ".join([words[i] for i in keep.tolist()])


RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
OUT = ("n_words", "runs", "collapsed_text")


def _find(batches):
    triple = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    for batch in batches:
        names = [n for n in batch.schema.names if n != "raw_text"]
        column = batch.column("raw_text")
        at = 0
        while at < batch.num_rows:
            numbers: dict[bytes, int] = {}
            words, texts, held, begin = [], [], 0, at
            while at < batch.num_rows and (at == begin or held < PIECE_WORDS):
                own = (column[at].as_py() or b"").split()
                words.append(own)
                texts.append(np.array([numbers.setdefault(w, len(numbers)) for w in own], np.int64))
                held += len(own)
                at += 1
            text, start, length, q = runs_of(texts)
            ends = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            short = [collapsed(w, start[a:b], length[a:b], q[a:b]) for w, a, b in zip(words, ends[:-1], ends[1:], strict=True)]
            part = batch.slice(begin, at - begin)
            runs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(q)], fields=list(triple))
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(n) for n in names), pa.array([len(w) for w in words], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), runs), pa.array(short, pa.binary()).cast(pa.string()),
                ],
                names=[*names, *OUT],
            )


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``n_words``, ``runs`` (start, length and
    period of every run, in words, by start and period) and ``collapsed_text``
    (the text without the repeats of its runs). Columns of these names are replaced."""
    kept = docs.drop(*OUT)
    columns = [F.col(f"d.`{c}`") for c in kept.columns]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("d"), F.col(f"`{text}`").cast("binary").alias("raw_text"))
    shape = T.StructType([rows.schema["d"], T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed_text", T.StringType())])
    return rows.mapInArrow(_find, shape).select(*columns, *OUT)
