"""DataFrame -> DataFrame operators of the clickstream transform."""

from clickweir.operators.clean import clean_events
from clickweir.operators.contract import contract_check
from clickweir.operators.enrich import enrich
from clickweir.operators.filters import REQUIRED_COLUMNS, require_columns
from clickweir.operators.key_counts import count_per_key
from clickweir.operators.marts import category_metrics, funnel_metrics, product_metrics
from clickweir.operators.metrics import batch_max_time
from clickweir.operators.traffic_cap import (
    DEFAULT_CAPS,
    Caps,
    Violators,
    cap_traffic,
    drop_violators,
    find_violators,
    violator_keys,
    with_minute,
)

__all__ = [
    "DEFAULT_CAPS",
    "REQUIRED_COLUMNS",
    "Caps",
    "Violators",
    "batch_max_time",
    "cap_traffic",
    "category_metrics",
    "clean_events",
    "contract_check",
    "count_per_key",
    "drop_violators",
    "enrich",
    "find_violators",
    "funnel_metrics",
    "product_metrics",
    "require_columns",
    "violator_keys",
    "with_minute",
]
