"""Columnar source scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickweir.schema import SOURCE_COLUMNS, SOURCE_SCHEMA


def read_events(spark: SparkSession, path: str, schema=SOURCE_SCHEMA) -> DataFrame:
    """Full snapshot of a Parquet event table, every column."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def pruned(df: DataFrame, columns: tuple[str, ...] = SOURCE_COLUMNS) -> DataFrame:
    """Keep only the source columns; Catalyst prunes the scan to them."""
    return df.select(*columns)
