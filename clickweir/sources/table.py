"""The clean target table on files: partitioned by ``event_date``, each
file sorted by ``(event_date, event_time, product_id)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickweir.schema import TARGET_COLUMNS, TARGET_SCHEMA, TARGET_SORT

# Ties of time and product go on to the user, so no hot moment is one task.
RANGE_KEYS = (*TARGET_SORT, "user_id", "user_session")


def write_clean_table(df: DataFrame, path: str, mode: str = "overwrite", time_ordered: bool = False, time_ranges: bool = False) -> None:
    """Write the 15 target columns, one folder per event date, each file
    sorted by ``(event_date, event_time, product_id)``.

    A REBALANCE exchange on the date, which AQE sizes by bytes (a hot date
    is split over several tasks, small ones are merged), gives every date a
    few files whatever the order of the rows. Rows of an append-only source
    that still stand in time order, each task holding about one date, need
    no exchange for that: ``time_ordered`` leaves it out. (After a shuffle
    join, or for a source split by another column, they do not.)

    ``time_ranges`` deals the rows by ranges of the sort order, whose bounds
    Spark samples (at most a million keys): the files of a date, a hot one
    included, overlap in no more than a time they both end at, so a filter on
    time skips files within a date. It evaluates ``df`` twice, so it suits
    rows that already stand in files.
    """
    if time_ordered and time_ranges:
        raise ValueError("time_ordered rows are not dealt by ranges")
    out = df.select(*TARGET_COLUMNS)
    if time_ranges:
        out = out.repartitionByRange(*RANGE_KEYS)
    elif not time_ordered:
        out = out.hint("rebalance", "event_date")
    out.sortWithinPartitions(*TARGET_SORT).write.mode(mode).partitionBy("event_date").parquet(path)


def read_clean_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TARGET_SCHEMA).parquet(path).select(*TARGET_COLUMNS)
