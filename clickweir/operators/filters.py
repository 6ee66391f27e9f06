"""Row filters of the transform."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns a row must have to be kept.
REQUIRED_COLUMNS = ("event_time", "product_id")


def require_columns(df: DataFrame, columns: tuple[str, ...] = REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows where any of ``columns`` is null (one Filter, pushed to the scan)."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
