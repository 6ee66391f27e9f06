"""Reading observed metrics.

When the input of an observed plan is empty, AQE may replace the plan
below a shuffle by an empty relation, and the observation node with it;
``Observation.get`` then has no row to return. ``observed`` turns that
case into ``None`` so callers can fall back to a direct query or to
zero counts.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def observed(obs: Observation) -> dict | None:
    try:
        return obs.get
    except Py4JJavaError as exc:
        if "toPyRow" in str(exc):
            return None
        raise
