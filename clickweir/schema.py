"""Column contracts of the clickstream source and of the clean target table."""

from __future__ import annotations

from pyspark.sql import types as T

# The source columns, in source-table order.
SOURCE_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)

# The columns the transform adds, in target-table order.
DERIVED_COLUMNS = (
    "event_date",
    "event_hour",
    "day_of_week",
    "category_level_1",
    "category_level_2",
    "category_level_3",
)

TARGET_COLUMNS = SOURCE_COLUMNS + DERIVED_COLUMNS

# Target storage order (partition column first, then the in-file sort).
TARGET_SORT = ("event_date", "event_time", "product_id")

# Columns the target declares NOT NULL.
TARGET_NOT_NULL = ("event_time", "event_type", "product_id", "event_date", "event_hour", "day_of_week")

PRICE_TYPE = T.DecimalType(14, 2)

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", PRICE_TYPE),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)

TARGET_SCHEMA = T.StructType(
    list(SOURCE_SCHEMA.fields)
    + [
        T.StructField("event_date", T.DateType()),
        T.StructField("event_hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("category_level_1", T.StringType()),
        T.StructField("category_level_2", T.StringType()),
        T.StructField("category_level_3", T.StringType()),
    ]
)
