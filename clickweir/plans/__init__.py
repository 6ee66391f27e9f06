"""Composite jobs: full refresh, increments, preview, marks, ledger."""

from clickweir.plans.jobs import (
    HWM_COLUMN,
    HWM_NAME,
    Preview,
    Target,
    deliver,
    increment_bounds,
    merge_loads,
    preview_increment,
    read_table,
    reset_mark,
    run_batch,
    run_full,
    run_incremental,
    stage_rows,
    vacuum,
)
from clickweir.plans.ledger import LEDGER_SCHEMA, Ledger
from clickweir.plans.marts_job import MARTS, load_dates, refresh_marts, update_marts

__all__ = [
    "HWM_COLUMN",
    "HWM_NAME",
    "LEDGER_SCHEMA",
    "Ledger",
    "MARTS",
    "Preview",
    "Target",
    "deliver",
    "increment_bounds",
    "load_dates",
    "merge_loads",
    "preview_increment",
    "read_table",
    "refresh_marts",
    "reset_mark",
    "run_batch",
    "run_full",
    "run_incremental",
    "stage_rows",
    "update_marts",
    "vacuum",
]
