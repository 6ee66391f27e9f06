"""Batch-level aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_max_time(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Global max of the event time over a (transformed) batch: one row."""
    return df.agg(F.max(time_col).alias("max_event_time"))

