"""Number of rows sharing a key, attached to every row (an unordered
``count(*) over (partition by keys)``).

A partial aggregate of the keys is joined back to the rows on null-safe
keys. Map-side combine shrinks the shuffled aggregate; the join is a
sort-merge join whose hot key partition AQE splits, so a key holding a
third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_per_key(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    renamed = {k: f"__key_{i}" for i, k in enumerate(keys)}
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    counts = counts.select(*[F.col(k).alias(v) for k, v in renamed.items()], name)
    cond = [df[k].eqNullSafe(counts[v]) for k, v in renamed.items()]
    return df.join(counts, cond, "inner").drop(*renamed.values())
