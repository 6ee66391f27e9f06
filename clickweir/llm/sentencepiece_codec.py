"""SentencePiece encoding and decoding in numpy.

Texts are bytes with a space in front (the dummy prefix; spaces stand for
the piece symbol U+2581). No piece crosses from a non-space to a space, nor
holds a byte that no piece holds, so a text falls into words that are
encoded on their own, each distinct one once. Words of equal length advance
together: substring hashes probe the sorted piece keys, and for each end
the maximum over all pieces ending there gives the best score and a
backpointer. Characters without a piece become byte pieces, so decoding
gives back the text, byte for byte, also where it holds U+2581 itself.

A unigram model's scores are log probabilities and are used as they are. A
merge (BPE) model's scores are only ranks 0, -1, -2, ...; summing ranks
would prefer many short frequent pieces, so they are turned into Zipf log
probabilities first. The result is then the unigram segmentation over the
model's pieces, not its merge order.

Null texts give null ids, empty texts an empty list; both decode to
themselves. Rows are handled one by one: repeated rows and null ids stay.
Ties between segmentations go to the longer last piece.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.llm.common import flat_text, row_pieces, starts_to_index
from clickweir.llm.words import BASE, mix, powers

SPACE = 0x20
SYMBOL = "▁"
UNKNOWN_TEXT = " ⁇ "  # Fixed value: how an unknown id is decoded.
UNKNOWN_PENALTY = 10.0  # Fixed value: below the lowest score.
CELLS = 1 << 18
CACHED_TOKENS = 3_000_000


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class PieceModel:
    pieces: list[bytes]  # by id, as decoded (a space for the symbol)
    scores: np.ndarray  # by id; -inf where not for encoding
    byte_ids: np.ndarray  # id of each byte piece

    def __post_init__(self):
        usable = np.flatnonzero(np.isfinite(self.scores))
        length = np.array([len(self.pieces[i]) for i in usable])
        self.lengths = np.unique(length)
        flat = np.frombuffer(b"".join(self.pieces[i] for i in usable), np.uint8)
        prefix = _prefix_hashes(flat[None, :])[0]
        ends = np.cumsum(length)
        # piece by piece: the hash a word's substring of that content has
        keys = np.zeros(len(usable), np.uint64)
        for n in self.lengths:
            at = np.flatnonzero(length == n)
            keys[at] = _spans(prefix, ends[at] - n, ends[at], int(n))
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], usable[order]
        self.table = np.zeros(1 << 20, bool)
        self.table[self.keys >> np.uint64(44)] = True
        held = np.zeros(256, bool)
        for i in usable:
            if len(self.pieces[i]) > 1:
                held[np.frombuffer(self.pieces[i], np.uint8)] = True
            if b" " in self.pieces[i].lstrip(b" "):
                raise ValueError("a piece crosses from a word into the next space")
        held[SPACE] = True
        self.loose = ~held
        self.piece_bytes = np.frombuffer(b"".join(self.pieces), np.uint8)
        self.piece_starts = np.concatenate([[0], np.cumsum([len(p) for p in self.pieces])]).astype(np.int64)
        self.unknown = float(self.scores[usable].min()) - UNKNOWN_PENALTY

    @property
    def size(self) -> int:
        return len(self.pieces)


def zipf_scores(ranks: np.ndarray) -> np.ndarray:
    """Log probabilities of a Zipf law over ranks 0, 1, 2, ..."""
    total = np.log(1 / (np.arange(len(ranks)) + 2)).astype(float)
    return -np.log(ranks + 2) - np.log(np.exp(total).sum())


def load_model(path: str | None = None) -> PieceModel:
    """Read a SentencePiece model file with byte pieces (on the driver)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or default_model_path())
    pieces, scores, byte_ids = [], np.full(sp.get_piece_size(), -np.inf), np.full(256, -1)
    for i in range(sp.get_piece_size()):
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(name[1:-1], 16)] = i
            pieces.append(bytes([int(name[1:-1], 16)]))
        elif sp.is_unknown(i):
            pieces.append(UNKNOWN_TEXT.encode())
        elif sp.is_control(i) or sp.is_unused(i):
            pieces.append(b"")
        else:
            pieces.append(name.replace(SYMBOL, " ").encode())
            scores[i] = sp.get_score(i)
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces, so texts would not survive")
    normal = np.isfinite(scores)
    if (scores[normal] == np.round(scores[normal])).all():
        scores[normal] = zipf_scores(-scores[normal])
    return PieceModel(pieces, scores, byte_ids)


def _prefix_hashes(rows: np.ndarray) -> np.ndarray:
    """(rows, length + 1) rolling hashes of every prefix."""
    out = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
    if rows.shape[0] == 1:
        # one long row: a running sum over weighted bytes, made to end alike
        return _one_prefix(rows[0])[None, :]
    for i in range(rows.shape[1]):
        out[:, i + 1] = out[:, i] * BASE + rows[:, i].astype(np.uint64) + np.uint64(1)
    return out


def _one_prefix(row: np.ndarray) -> np.ndarray:
    n = len(row)
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    down = np.full(max(n, 1), inverse, np.uint64)
    down = np.cumprod(down)[:n]  # BASE ** -(i + 1)
    total = np.cumsum((row.astype(np.uint64) + np.uint64(1)) * down)
    out = np.zeros(n + 1, np.uint64)
    out[1:] = total * (powers(n) * BASE)[:n]
    return out


def _spans(prefix: np.ndarray, starts, ends, n: int) -> np.ndarray:
    """Keys of substrings of length ``n``, from the prefix hashes."""
    return mix(prefix[..., ends] - prefix[..., starts] * powers(n + 1)[n] + np.uint64(n))


def encode_equal(words: np.ndarray, model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """Best segmentation of words of one length, ``(words, length)`` bytes:
    (ids of all words one after another, ids per word)."""
    count, length = words.shape
    prefix = _prefix_hashes(words)
    best = np.full((count, length + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((count, length + 1), np.int32)  # length of the last piece
    pick = np.zeros((count, length + 1), np.int32)  # its id
    rows = np.arange(count)
    sizes = [int(n) for n in model.lengths[::-1] if n <= length]
    step = max(32, CELLS // max(count, 1))
    for low in range(1, length + 1, step):
        high = min(length, low + step - 1)  # ends low .. high
        tables = []
        for n in sizes:
            first = max(low, n)
            if first > high:
                continue
            keys = mix(prefix[:, first : high + 1] - prefix[:, first - n : high + 1 - n] * powers(n + 1)[n] + np.uint64(n))
            at = np.flatnonzero(model.table[(keys >> np.uint64(44)).ravel()])
            probe = keys.ravel()[at]
            index = np.minimum(np.searchsorted(model.keys, probe), len(model.keys) - 1)
            hit = model.keys[index] == probe
            if not hit.any():
                continue
            found = np.full(keys.size, -1, np.int32)
            found[at[hit]] = model.key_ids[index[hit]]
            tables.append((n, first, found.reshape(keys.shape)))
        for end in range(low, high + 1):
            byte = words[:, end - 1]
            # a byte piece: the first byte of a character pays for the whole
            top = best[:, end - 1] + np.where((byte & 0xC0) == 0x80, 0.0, model.unknown)
            size, piece = np.ones(count, np.int32), model.byte_ids[byte].astype(np.int32)
            for n, first, found in tables:
                if end < first:
                    continue
                ids = found[:, end - first]
                have = np.flatnonzero(ids >= 0)
                if not len(have):
                    continue
                score = best[have, end - n] + model.scores[ids[have]]
                better = score > top[have]
                won = have[better]
                top[won], size[won], piece[won] = score[better], n, ids[won]
            best[:, end], back[:, end], pick[:, end] = top, size, piece
    # walk all words back together
    at = np.full(count, length)
    owner, ids = [], []
    live = rows
    while len(live):
        owner.append(live)
        ids.append(pick[live, at[live]])
        at[live] -= back[live, at[live]]
        live = live[at[live] > 0]
    owner, ids = np.concatenate(owner)[::-1], np.concatenate(ids)[::-1]
    order = np.argsort(owner, kind="stable")
    return ids[order], np.bincount(owner, minlength=count)


class Encoder:
    """Encodes flat byte arrays; remembers the words it has seen, up to
    ``CACHED_TOKENS`` ids."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.index: dict[int, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def _words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word starts of rows, and words per row."""
        loose = self.model.loose[data]
        space = data == SPACE
        first = loose.copy()
        first[1:] |= loose[:-1] | (space[1:] & ~space[:-1])
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(first)
        return starts, np.diff(np.searchsorted(starts, offsets))

    def _learn(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: list[int]) -> None:
        begin, counts = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        grown, top = [self.flat], len(self.flat)
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n)
            step = max(1, CELLS // int(n))
            for i in range(0, len(rows), step):
                part = rows[i : i + step]
                words = data[starts[part][:, None] + np.arange(n)[None, :]]
                flat, per = encode_equal(words, self.model)
                begin[part] = top + np.cumsum(per) - per
                counts[part] = per
                grown.append(flat)
                top += len(flat)
        base = len(self.counts)
        self.index.update(zip(keys, range(base, base + len(keys)), strict=True))
        self.flat = np.concatenate(grown)
        self.starts = np.concatenate([self.starts, begin])
        self.counts = np.concatenate([self.counts, counts])

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per row) of a flat byte array."""
        if len(self.flat) > CACHED_TOKENS:
            self.forget()
        sizes = np.diff(offsets)
        some = sizes > 0
        data = np.full(len(raw) + int(some.sum()), SPACE, np.uint8)
        grown = sizes + some
        off = np.concatenate([[0], np.cumsum(grown)])
        data[starts_to_index(off[:-1] + 1, sizes)] = raw
        starts, words = self._words(data, off)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(sizes), np.int64)
        lengths = np.diff(np.append(starts, len(data)))
        place = np.arange(len(data)) - np.repeat(starts, lengths)
        weighted = (data.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[place]
        hashes = mix(np.add.reduceat(weighted, starts) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        ids, unique = pd.factorize(hashes)
        first = np.zeros(len(unique), np.int64)
        first[ids[::-1]] = np.arange(len(ids) - 1, -1, -1)
        keys = unique.tolist()
        new = [i for i, k in enumerate(keys) if k not in self.index]
        if new:
            at = first[new]
            self._learn(data, starts[at], lengths[at], [keys[i] for i in new])
        rows = np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))[ids]
        counts = self.counts[rows]
        total = np.concatenate([[0], np.cumsum(counts)])
        ends = np.concatenate([[0], np.cumsum(words)])
        return self.flat[starts_to_index(self.starts[rows], counts)], np.diff(total[ends])


def decode(ids: np.ndarray, counts: np.ndarray, model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the rows of ids, without the leading space."""
    starts = model.piece_starts[ids]
    lengths = model.piece_starts[ids + 1] - starts
    data = model.piece_bytes[starts_to_index(starts, lengths)]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    off = ends[np.concatenate([[0], np.cumsum(counts)])]
    heads = off[:-1][np.diff(off) > 0]
    drop = heads[data[heads] == SPACE]
    kept = np.ones(len(data), bool)
    kept[drop] = False
    return data[kept], off - np.searchsorted(drop, off, side="left")


def _ids_array(ids: np.ndarray, counts: np.ndarray, nulls: np.ndarray | None) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    mask = pa.array(nulls) if nulls is not None and nulls.any() else None
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()), mask=mask)


def encode_column(encoder: Encoder, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, ids per row, bytes, offsets) of an Arrow text column."""
    data, off = flat_text(col)
    ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for i, j in row_pieces(off):
        a, b = encoder.encode(data[off[i] : off[j]], off[i : j + 1] - off[i])
        ids.append(a)
        counts.append(b)
    return np.concatenate(ids), np.concatenate(counts), data, off


def encode_texts(docs: DataFrame, model: PieceModel, text: str = "text", out: str = "token_ids", checked: str | None = None) -> DataFrame:
    """All columns of ``docs`` plus ``out``, the ids; with ``checked``, also
    whether decoding them gives back the text (null for null)."""
    kept = docs.drop(out, *([checked] if checked else []))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the vocabulary

    def run(batches):
        encoder = Encoder(shared.value)
        for whole in batches:
            # a piece at a time: ids and decoded bytes of a whole batch would be many times its text
            _, sizes = flat_text(whole.column(text))
            for i, j in row_pieces(sizes):
                batch = whole.slice(i, j - i)
                col = batch.column(text)
                nulls = col.is_null().to_numpy(zero_copy_only=False)
                data, off = flat_text(col)
                ids, counts = encoder.encode(data, off)
                columns, names = [*batch.columns, _ids_array(ids, counts, nulls)], [*batch.schema.names, out]
                if checked:
                    back, back_off = decode(ids, counts, encoder.model)
                    same = np.diff(back_off) == np.diff(off)
                    for r in np.flatnonzero(same):
                        same[r] = np.array_equal(back[back_off[r] : back_off[r + 1]], data[off[r] : off[r + 1]])
                    columns.append(pa.array(same, mask=nulls))
                    names.append(checked)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [*kept.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]
    if checked:
        fields.append(T.StructField(checked, T.BooleanType()))
    return kept.mapInArrow(run, T.StructType(fields))


def decode_texts(rows: DataFrame, model: PieceModel, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """All columns of ``rows`` plus ``out``, the decoded text. Null ids give
    null; ids of no piece, null ones included, are refused."""
    kept = rows.drop(out)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            col = batch.column(ids)
            nulls = col.is_null().to_numpy(zero_copy_only=False)
            counts = np.nan_to_num(col.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            flat = col.flatten()
            if flat.null_count:
                raise ValueError("null among the ids")
            flat = flat.to_numpy().astype(np.int64)
            if len(flat) and (flat.min() < 0 or flat.max() >= m.size):
                raise ValueError("an id outside the vocabulary")
            data, off = decode(flat, counts, m)
            raw = data.tobytes()
            texts = [None if null else raw[a:b].decode("utf-8", "replace") for a, b, null in zip(off[:-1].tolist(), off[1:].tolist(), nulls, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())]))


def token_count(ids: str = "token_ids"):
    """Ids per row; 0 for null."""
    return F.when(F.col(ids).isNull(), 0).otherwise(F.size(ids)).cast("long")
