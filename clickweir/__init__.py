"""clickweir: a Spark-native clickstream cleaning and loading engine.

    from clickweir import Caps, clean_events, run_full, run_incremental, read_table
"""

from clickweir.operators import DEFAULT_CAPS, Caps, clean_events
from clickweir.plans import (
    Ledger,
    Target,
    merge_loads,
    preview_increment,
    read_table,
    reset_mark,
    run_full,
    run_incremental,
    vacuum,
)
from clickweir.sources import ingest_csv, read_events, write_clean_table
from clickweir.streaming import start_stream

__version__ = "0.1.0"

__all__ = [
    "DEFAULT_CAPS",
    "Caps",
    "Ledger",
    "Target",
    "clean_events",
    "ingest_csv",
    "merge_loads",
    "preview_increment",
    "read_events",
    "read_table",
    "reset_mark",
    "run_full",
    "run_incremental",
    "start_stream",
    "vacuum",
    "write_clean_table",
]
