"""Summary tables over the clean events (product, category, funnel).

The reference names these three tables and defines none of them; the
measures here are this package's. All are grouped aggregates with
map-side partial aggregation; the distinct-user counts are exact (Spark
plans them as a two-level aggregate keyed by the user as well, so one
hot product or date is spread over many tasks).

Each takes the clean events, or ``partial_events`` of them: rows that stand
for ``n_events`` events with ``price_sum`` in total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Event types of an e-commerce clickstream, and the
# default funnel through them.
EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")
FUNNEL_STAGES = ("view", "cart", "purchase")
PURCHASE = "purchase"


PARTIAL_KEYS = ("event_date", "product_id", "category_level_1", "category_level_2", "event_type", "user_id")


def partial_events(clean: DataFrame) -> DataFrame:
    """One row for all events that agree in everything the tables group or
    count by; the three tables are roll-ups of it."""
    return clean.groupBy(*PARTIAL_KEYS).agg(F.count(F.lit(1)).alias("n_events"), F.sum("price").cast("decimal(24,2)").alias("price_sum"))


def merged_partials(parts: DataFrame) -> DataFrame:
    """One row again for each key, from the partial rows of several loads."""
    return parts.groupBy(*PARTIAL_KEYS).agg(F.sum("n_events").alias("n_events"), F.sum("price_sum").cast("decimal(24,2)").alias("price_sum"))


def _measures(df: DataFrame, event_types: tuple[str, ...], purchase: str) -> list[Column]:
    et = F.col("event_type")
    partial = "n_events" in df.columns
    n, price = (F.col("n_events"), F.col("price_sum")) if partial else (F.lit(1).cast("long"), F.col("price"))
    none = F.lit(0).cast("long")
    return (
        [F.sum(n).alias("events")]
        + [F.coalesce(F.sum(F.when(et == F.lit(t), n)), none).alias(f"{t}_events") for t in event_types]
        + [
            F.count_distinct("user_id").alias("users"),
            F.coalesce(F.sum(F.when(et == F.lit(purchase), price)), F.lit(0).cast("decimal(24,2)"))
            .cast("decimal(24,2)")
            .alias("revenue"),
        ]
    )


def product_metrics(
    clean: DataFrame, event_types: tuple[str, ...] = EVENT_TYPES, purchase: str = PURCHASE
) -> DataFrame:
    """Per (event_date, product_id): events, events per type, distinct users, purchase revenue."""
    return clean.groupBy("event_date", "product_id").agg(*_measures(clean, event_types, purchase))


def category_metrics(
    clean: DataFrame, event_types: tuple[str, ...] = EVENT_TYPES, purchase: str = PURCHASE
) -> DataFrame:
    """Per (event_date, category_level_1, category_level_2): the same measures."""
    return clean.groupBy("event_date", "category_level_1", "category_level_2").agg(
        *_measures(clean, event_types, purchase)
    )


def funnel_metrics(clean: DataFrame, stages: tuple[str, ...] = FUNNEL_STAGES) -> DataFrame:
    """Per event_date: distinct users reaching each stage, and step rates.

    A user reaches stage i on a day when that day holds at least one event
    of every stage 1..i (order of events within the day is not required).
    Rows with a null user are not counted. Stage columns are
    ``stage_<i>_users``; ``stage_<i>_rate`` is users at i over users at
    i-1, null when the earlier stage has none.
    """
    et = F.col("event_type")
    flags = [F.max(F.when(et == F.lit(s), 1).otherwise(0)).alias(f"__s{i}") for i, s in enumerate(stages, 1)]
    per_user = clean.filter(F.col("user_id").isNotNull()).groupBy("event_date", "user_id").agg(*flags)
    reached = []
    acc = F.lit(1)
    for i in range(1, len(stages) + 1):
        acc = acc * F.col(f"__s{i}")
        reached.append(F.sum(acc).cast("bigint").alias(f"stage_{i}_users"))
    out = per_user.groupBy("event_date").agg(*reached)
    rates = [
        F.when(F.col(f"stage_{i - 1}_users") > 0, F.round(F.col(f"stage_{i}_users") / F.col(f"stage_{i - 1}_users"), 6)).alias(
            f"stage_{i}_rate"
        )
        for i in range(2, len(stages) + 1)
    ]
    return out.select("event_date", *[f"stage_{i}_users" for i in range(1, len(stages) + 1)], *rates)
