"""Clickstream view over the driver's test tables (``events`` + ``part``).

The driver tables have no clickstream columns, so this view derives them
deterministically and plants nulls and dirty values at fixed residues of
``event_id`` so that every cleaning rule has rows to act on. It drops no
rows of its own. ``event_id`` is kept as a row id; it is not part of the
target schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.schema import PRICE_TYPE, SOURCE_COLUMNS

# Residues of event_id that plant a null or dirty value.
NULL_TIME_EVERY = 97
NULL_PRODUCT_EVERY = 89
NULL_SESSION_EVERY = 101
CATEGORY_CYCLE = 11  # 0 -> 'nan', 1 -> ' NaN ', 2 -> null, 3 -> one level, else three levels


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def clickstream_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id`` plus the nine source columns."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size"
    )
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    # the size of Parquet files says little of their rows': by it ``part`` would be collected and
    # broadcast in every pass while it has millions of rows
    joined = events.join(part.hint("merge"), k == part.p_partkey, "left")
    ptype = F.lower("p_type")
    slot = F.col("event_id") % CATEGORY_CYCLE
    category = (
        F.when(slot == 0, F.lit("nan"))
        .when(slot == 1, F.lit(" NaN "))
        .when(slot == 2, F.lit(None).cast("string"))
        .when(slot == 3, ptype)
        .otherwise(F.concat(ptype, F.lit("."), F.replace("p_name", F.lit(" "), F.lit("."))))
    )
    null_str = F.lit(None).cast("string")
    return joined.select(
        "event_id",
        F.when(_every(NULL_TIME_EVERY), F.lit(None).cast("timestamp_ntz")).otherwise(F.col("ts")).alias("event_time"),
        "event_type",
        F.when(_every(NULL_PRODUCT_EVERY), F.lit(None).cast("bigint")).otherwise(F.col("p_partkey")).alias("product_id"),
        F.col("p_size").cast("bigint").alias("category_id"),
        category.alias("category_code"),
        F.col("p_brand").alias("brand"),
        F.col("value").cast(PRICE_TYPE).alias("price"),
        "user_id",
        F.when(_every(NULL_SESSION_EVERY), null_str)
        .otherwise(F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string")))
        .alias("user_session"),
    )


def clickstream_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine source columns only, as the reference's source table holds them."""
    return clickstream_view(spark, sf_dir).select(*SOURCE_COLUMNS)
