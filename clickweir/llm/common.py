"""Helpers shared by the operators of this subpackage: flat byte views of
Arrow text columns, row identity, and tables written to the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.fs import delete_at_exit
from clickweir.session import work_path

PIECE_BYTES = 1 << 20


def flat_text(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    empty = b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else ""
    arr = col.fill_null(empty).cast(pa.large_binary())
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def row_pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def id_mod(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def unit_hash(*columns: str) -> Column:
    """A value in [0, 1) fixed by the columns, for bounded samples."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, so
    a lost executor costs no recomputation of what came before."""
    path = work_path(df.sparkSession, name)
    delete_at_exit(df.sparkSession, path)  # what is returned reads it until then
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def starts_to_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``starts[i] .. starts[i] + lengths[i]``."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def wrapped(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and all of ``docs`` as one struct ``row``: whatever names an
    operator adds, none clashes. ``select("row.*")`` unwraps."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)
