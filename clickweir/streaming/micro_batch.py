"""Loading a folder of arriving files by Structured Streaming.

New files of a Parquet source directory arrive as micro-batches; each
micro-batch is one load (``foreachBatch``, where the batch is a static
frame, so the two unordered-window caps hold per batch exactly as for an
increment). Every row of every file is loaded, in whatever order the files
arrive and however many make up a batch: no mark takes part. The load is
committed under the stream's id and the batch's number, so a batch that the
engine replays after a failure is skipped.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickweir.fs import read_text
from clickweir.operators.traffic_cap import DEFAULT_CAPS, Caps
from clickweir.plans.jobs import Target, run_batch
from clickweir.schema import SOURCE_SCHEMA


def start_stream(
    spark: SparkSession,
    source_path: str,
    target: Target | str,
    caps: Caps = DEFAULT_CAPS,
    schema=SOURCE_SCHEMA,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream. Without ``processing_time`` it drains what is there
    (``availableNow``) and stops; with it, it polls at that interval.
    ``max_files_per_trigger`` sets how many files make up a batch (caps
    count within a batch)."""
    t = target if isinstance(target, Target) else Target(target)
    where = checkpoint or f"{t.root}/_stream"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)

    def each(batch: DataFrame, batch_id: int) -> None:
        # the id a checkpoint keeps over restarts; a new checkpoint is a new stream
        stream_id = json.loads(read_text(spark, f"{where}/metadata"))["id"]
        run_batch(batch.sparkSession, batch, t, f"{stream_id}:{batch_id}", caps)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", where)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()
