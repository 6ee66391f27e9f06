"""The clickstream transform: filter, cap, enrich, project."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickweir.operators.enrich import enrich
from clickweir.operators.filters import require_columns
from clickweir.operators.traffic_cap import (
    BROADCAST_BYTES,
    DEFAULT_CAPS,
    Caps,
    Violators,
    cap_traffic,
    drop_violators,
)
from clickweir.schema import SOURCE_COLUMNS, TARGET_COLUMNS


def clean_events(
    df: DataFrame,
    caps: Caps = DEFAULT_CAPS,
    broadcast_bytes: int = BROADCAST_BYTES,
    violators: Violators | None = None,
) -> DataFrame:
    """Source rows -> the 15 target columns.

    Rows without ``event_time`` or ``product_id`` are dropped, then the
    traffic caps (both counts over the same rows), then the derived
    columns are added. One aggregate job runs here and the returned frame
    is the lazy second pass; ``violators`` passes keys a job already
    aggregated from exactly these rows.
    """
    missing = [c for c in SOURCE_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    rows = require_columns(df)
    kept = cap_traffic(rows, caps, broadcast_bytes) if violators is None else drop_violators(rows, violators, broadcast_bytes)
    return enrich(kept).select(*TARGET_COLUMNS)
