"""Target-contract report: how many rows would break the target's types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.schema import TARGET_NOT_NULL

# decimal(14,2) holds at most 12 integer digits.
_PRICE_LIMIT = 10**12


def contract_check(df: DataFrame) -> DataFrame:
    """One row of violation counts, in a single aggregate.

    ``null_<col>`` for each column the target declares NOT NULL,
    ``sub_second_event_time`` for times the target's second-precision
    DateTime would truncate, ``price_out_of_range`` for prices that do not
    fit decimal(14,2). The transform never filters on ``event_type``, so
    a null there shows up here and is not dropped silently. Run it on rows
    whose price is still as wide as the source's: one already cast to
    decimal(14,2) can no longer be out of range.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in TARGET_NOT_NULL]
    aggs += [
        F.count_if(F.col("event_time") != F.date_trunc("second", "event_time")).alias(
            "sub_second_event_time"
        ),
        F.count_if(F.abs(F.round("price", 2)) >= _PRICE_LIMIT).alias("price_out_of_range"),
    ]
    return df.agg(*aggs)
