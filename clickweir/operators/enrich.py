"""Per-row enrichment: category cleanup, calendar fields, category levels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickweir.functions import (
    category_level,
    clean_category_code,
    day_of_week,
    event_date,
    event_hour,
)


def enrich(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Add the six derived target columns in one projection.

    Levels are split from the *cleaned* category code, so a ``nan`` code
    yields three null levels.
    """
    cleaned = df.withColumn("category_code", clean_category_code("category_code"))
    return cleaned.withColumns(
        {
            "event_date": event_date(time_col),
            "event_hour": event_hour(time_col),
            "day_of_week": day_of_week(time_col),
            "category_level_1": category_level("category_code", 1),
            "category_level_2": category_level("category_code", 2),
            "category_level_3": category_level("category_code", 3),
        }
    )
