"""Token counts of the documents in flat, unindexed token files.

A token file is nothing but little-endian ids, each document followed by the
end-of-document id. Files are read in fixed-size blocks by byte range, in
parallel and whatever the documents' bounds; each block finds its
end-of-document ids with one vectorised comparison. A prefix scan over the
block summaries (documents ended before, place of the last separator before)
stitches documents that cross blocks. The scan runs in two levels, groups
of ``GROUP_BLOCKS`` blocks first, so one huge file is not one task's work.

Empty documents count 0 tokens. Tokens after the last separator form a last,
unended document; a file that ends with a separator, and an empty file, have
none. No files: no rows. A file that is not a whole number of ids is refused.

Files are opened through ``pyarrow.fs`` by URI (local or shared mounts,
HDFS, S3, GCS). Written files have names of their own for each attempt, and only those
named in the manifest count, so a retried task leaves nothing but an
unread file.
"""

from __future__ import annotations

import posixpath
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.fs import delete_at_exit
from clickweir.llm.common import written
from clickweir.llm.sentencepiece_codec import Encoder, PieceModel, encode_column
from clickweir.session import work_path

BLOCK_TOKENS = 1 << 21
GROUP_BLOCKS = 1024
FILE_TOKENS = 1 << 28
BLOCKS_A_TASK = 2


def _open(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])


def token_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


MANIFEST = T.StructType(
    [
        T.StructField("token_file", T.StringType()),
        T.StructField("file_bytes", T.LongType()),
        T.StructField("doc_no", T.LongType()),
        T.StructField("doc_id", T.LongType()),
    ]
)


def write_token_files(docs: DataFrame, model: PieceModel, eod: int, text: str = "text", doc_id: str = "doc_id", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encode the texts into flat token files in the shared folder, one or
    more a task. Returns the manifest: file, its size, place of each
    document in it, ``doc_id``. Null texts are empty documents."""
    folder = work_path(docs.sparkSession, "tokens")
    delete_at_exit(docs.sparkSession, folder)
    kind = token_type(model.size)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def write(batches):
        encoder = Encoder(shared.value)
        system, root = _open(folder)
        out, name, ids_written, doc_ids = None, "", 0, []

        def rows():
            n = len(doc_ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * n), pa.array([ids_written * np.dtype(kind).itemsize] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(doc_ids, pa.int64())],
                names=MANIFEST.names,
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                system.create_dir(root, recursive=True)
                name = f"part-{uuid.uuid4().hex}.tokens"
                out, ids_written, doc_ids = system.open_output_stream(posixpath.join(root, name)), 0, []
            ids, counts, _, _ = encode_column(encoder, batch.column("text"))
            ends = np.cumsum(counts)
            block = np.insert(ids, ends, eod).astype(kind)
            out.write(block.tobytes())
            ids_written += len(block)
            doc_ids += batch.column("doc_id").to_pylist()
            if ids_written >= file_tokens:
                out.close()
                out = None
                yield rows()
        if out is not None:
            out.close()
            yield rows()

    picked = docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc_id"))
    manifest = picked.mapInArrow(write, MANIFEST).withColumn("token_file", F.concat(F.lit(folder + "/"), "token_file"))
    return written(manifest, "token-manifest")


BLOCK_SCHEMA = T.StructType(
    [
        T.StructField("token_file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("ends", T.ArrayType(T.LongType())),  # places of separators in the file
        T.StructField("last_id", T.BooleanType()),  # the file's last block
        T.StructField("size", T.LongType()),  # ids in the file
    ]
)


def scan_blocks(files: DataFrame, eod: int, kind: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row a block of each file: the places of its separators.
    ``files``: distinct ``token_file`` and ``file_bytes``."""
    width = np.dtype(kind).itemsize
    blocks = F.greatest(F.ceil(F.col("file_bytes") / (block_tokens * width)), F.lit(1))
    total = files.agg(F.sum(blocks)).first()[0] or 1
    ranges = files.select("token_file", "file_bytes", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)).alias("block"))
    spread = ranges.repartition(max(1, -(-int(total) // BLOCKS_A_TASK)), "token_file", "block")

    def scan(batches):
        for batch in batches:
            for name, size, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size % width:
                    raise ValueError(f"{name}: {size} bytes are no whole number of ids")
                system, path = _open(name)
                start = block * block_tokens
                with system.open_input_file(path) as file:
                    raw = file.read_at(min(block_tokens * width, size - start * width), start * width) if size else b""
                ends = np.flatnonzero(np.frombuffer(raw, kind) == eod) + start
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([block], pa.int64()), pa.array([ends], pa.list_(pa.int64())), pa.array([(start + block_tokens) * width >= size]), pa.array([size // width], pa.int64())],
                    names=BLOCK_SCHEMA.names,
                )

    return spread.select("token_file", "file_bytes", "block").mapInArrow(scan, BLOCK_SCHEMA)


def stitch(blocks: DataFrame) -> DataFrame:
    """(token_file, doc_no, n_tokens) of every document, by a two-level
    prefix scan over the block summaries."""
    last = F.element_at("ends", -1)
    own = blocks.withColumn("group", F.floor(F.col("block") / GROUP_BLOCKS)).withColumn("n_ends", F.size("ends").cast("long"))
    own = own.withColumn("last_end", F.when(F.col("n_ends") > 0, last))
    groups = own.groupBy("token_file", "group").agg(F.sum("n_ends").alias("group_ends"), F.max("last_end").alias("group_last"))
    over = Window.partitionBy("token_file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    before = groups.select(
        "token_file",
        "group",
        F.coalesce(F.sum("group_ends").over(over), F.lit(0)).alias("docs_before_group"),
        F.coalesce(F.max("group_last").over(over), F.lit(-1)).alias("end_before_group"),
    )
    inner = Window.partitionBy("token_file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        own.withColumn("docs_inside", F.coalesce(F.sum("n_ends").over(inner), F.lit(0)))
        .withColumn("end_inside", F.max("last_end").over(inner))
        .join(before, ["token_file", "group"])
        .withColumn("doc_base", F.col("docs_before_group") + F.col("docs_inside"))
        .withColumn("end_before", F.coalesce("end_inside", "end_before_group"))
    )
    # a last document without separator ends where the file does
    tail = F.col("last_id") & (F.col("size") > F.coalesce("last_end", "end_before") + 1)
    marks = F.concat(F.array("end_before"), "ends", F.when(tail, F.array("size")).otherwise(F.array().cast("array<bigint>")))
    lengths = F.transform(F.slice(marks, 2, F.greatest(F.size(marks) - 1, F.lit(0))), lambda end, i: end - F.element_at(marks, i + 1) - 1)
    return carried.select("token_file", "doc_base", F.posexplode(lengths).alias("k", "n_tokens")).select(
        "token_file", (F.col("doc_base") + F.col("k")).alias("doc_no"), "n_tokens"
    )


def count_tokens(files: DataFrame, eod: int, kind: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(token_file, doc_no, n_tokens) of every document of the files."""
    return stitch(written(scan_blocks(files, eod, kind, block_tokens), "token-blocks"))
