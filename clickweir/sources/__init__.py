"""Sources and sinks: Parquet, JDBC, CSV ingest, the clean table, the test-data view."""

from clickweir.sources.csv_ingest import ingest_csv, limit_rows, normalize, read_raw_csv
from clickweir.sources.fixture import clickstream_source, clickstream_view
from clickweir.sources.jdbc import (
    jdbc_options,
    read_jdbc,
    read_jdbc_parallel,
    read_jdbc_source,
    write_jdbc,
)
from clickweir.sources.parquet import pruned, read_events
from clickweir.sources.table import read_clean_table, write_clean_table

__all__ = [
    "clickstream_source",
    "clickstream_view",
    "ingest_csv",
    "jdbc_options",
    "limit_rows",
    "normalize",
    "pruned",
    "read_clean_table",
    "read_events",
    "read_jdbc",
    "read_jdbc_parallel",
    "read_jdbc_source",
    "read_raw_csv",
    "write_clean_table",
    "write_jdbc",
]
