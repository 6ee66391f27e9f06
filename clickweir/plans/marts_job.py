"""Materialize the summary tables from the published clean table.

``refresh_marts`` scans the clean table once: a partial aggregate by date, product,
category levels, event type and user is written to the shared folder, and
the three tables are roll-ups of it. A full rebuild is written beside each
table and then put in its place. With given dates only those are recomputed: the clean
table is read with a filter on its partition column (partition pruning), and each
summary table is written with dynamic partition overwrite, which replaces just
those date folders.

``update_marts`` keeps the tables up as loads come in and reads no row of the clean
table twice. The partial aggregate of new loads is stored::

    <marts_root>/_partials/part=<id>/event_date=<d>/  partial rows of some loads
    <marts_root>/_state/<number>.json                 parts, and the loads that the tables hold

and the dates they touched are rolled up anew from the parts of those dates. Partial
rows of different loads add up, and as they are by user, distinct users stay exact. Parts
are merged by levels: ``PARTS`` of one level become one of the next, so there are
few of them and a row is rewritten as often as the logarithm of the loads.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.fs import delete_path, list_dirs, list_files, put_if_absent, read_text, replace_dir
from clickweir.operators.marts import EVENT_TYPES, FUNNEL_STAGES, category_metrics, funnel_metrics, merged_partials, partial_events, product_metrics
from clickweir.plans.jobs import Target, read_loads, read_table
from clickweir.plans.ledger import FULL, MERGE, SUCCESS, ConflictingRun, Ledger
from clickweir.schema import TARGET_SCHEMA
from clickweir.session import work_path

MARTS = ("product_metrics", "category_metrics", "funnel_metrics")
# Parts of one level that are merged into one of the next.
PARTS = 8


def load_dates(spark: SparkSession, target: Target | str, load: str) -> list[dt.date]:
    """Event dates a load wrote, from its folder names (no data read)."""
    t = target if isinstance(target, Target) else Target(target)
    return _dates(spark, t.load_path(load))


def _dates(spark: SparkSession, path: str) -> list[dt.date]:
    return sorted(dt.date.fromisoformat(n.split("=", 1)[1]) for n in list_dirs(spark, path) if n.startswith("event_date="))


def _marts(clean: DataFrame, event_types, stages) -> dict[str, DataFrame]:
    return {
        "product_metrics": product_metrics(clean, event_types),
        "category_metrics": category_metrics(clean, event_types),
        "funnel_metrics": funnel_metrics(clean, stages),
    }


def _publish(spark: SparkSession, marts_root: str, partial: DataFrame, event_types, stages, whole: bool) -> None:
    """Write the roll-ups of ``partial``: the whole tables, or the dates it holds."""
    for name, df in _marts(partial, event_types, stages).items():
        if whole:
            new = f"{marts_root}/.new-{uuid.uuid4().hex}-{name}"  # on the tables' own file system
            df.write.partitionBy("event_date").parquet(new)
            replace_dir(spark, new, f"{marts_root}/{name}")
        else:
            writer = df.write.partitionBy("event_date").mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.parquet(f"{marts_root}/{name}")


def refresh_marts(
    spark: SparkSession,
    target: Target | str,
    marts_root: str,
    dates: list[dt.date] | None = None,
    event_types: tuple[str, ...] = EVENT_TYPES,
    stages: tuple[str, ...] = FUNNEL_STAGES,
) -> None:
    """Rebuild the three tables (``dates=None``) or only the given dates."""
    clean = read_table(spark, target)
    if dates is not None:
        if not dates:
            return
        clean = clean.filter(F.col("event_date").isin(list(dates)))
    scratch = work_path(spark, "marts-partial")
    try:
        partial = partial_events(clean)
        partial.write.parquet(scratch)
        _publish(spark, marts_root, spark.read.schema(partial.schema).parquet(scratch), event_types, stages, dates is None)
    finally:
        delete_path(spark, scratch)


def original_loads(ledger: Ledger) -> list[str]:
    """The loads whose rows make up the published table, as they were before
    any merge of loads, oldest first."""
    published = ledger.committed_loads()
    if not any(x.startswith(f"{MERGE}-") for x in published):
        return published
    runs = ledger.runs().filter((F.col("status") == SUCCESS) & F.col("load").isNotNull()).select("seq", "job_type", "load")
    loads: list[str] = []
    for r in sorted(runs.collect(), key=lambda r: r["seq"]):  # one small row a run
        if r["job_type"] == FULL:
            loads = []
        if r["job_type"] != MERGE:
            loads.append(r["load"])
    return loads


def _state(spark: SparkSession, marts_root: str) -> tuple[int, dict]:
    """(number, state) of the last update; (-1, an empty one) before the first."""
    numbers = [int(f.rsplit("/", 1)[1][:-5]) for f in list_files(spark, f"{marts_root}/_state") if f.endswith(".json")]
    if not numbers:
        return -1, {"parts": [], "shown": [], "event_types": [], "stages": []}
    return max(numbers), json.loads(read_text(spark, _state_file(marts_root, max(numbers))))


def _state_file(marts_root: str, number: int) -> str:
    return f"{marts_root}/_state/{number:012d}.json"


def _part_path(marts_root: str, part: dict) -> str:
    return f"{marts_root}/_partials/part={part['id']}"


def _read_parts(spark: SparkSession, marts_root: str, parts: list[dict]) -> DataFrame:
    rows = partial_events(spark.createDataFrame([], TARGET_SCHEMA))
    if not parts:
        return rows
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.StringType())])
    reader = spark.read.schema(schema).option("basePath", f"{marts_root}/_partials")
    return reader.parquet(*[_part_path(marts_root, p) for p in parts]).select(*rows.columns)


def _write_part(marts_root: str, rows: DataFrame, loads: list[str], level: int) -> dict:
    part = {"id": uuid.uuid4().hex, "level": level, "loads": loads}
    # a few files a date, a hot one included: AQE sizes them by bytes
    rows.hint("rebalance", "event_date").write.partitionBy("event_date").parquet(_part_path(marts_root, part))
    return part


def _merge_levels(spark: SparkSession, marts_root: str, parts: list[dict]) -> list[dict]:
    level = 0
    while any(p["level"] >= level for p in parts):
        same = [p for p in parts if p["level"] == level]
        if len(same) >= PARTS:
            rows = merged_partials(_read_parts(spark, marts_root, same))
            merged = _write_part(marts_root, rows, [x for p in same for x in p["loads"]], level + 1)
            parts = [p for p in parts if p["level"] != level] + [merged]
        level += 1
    return parts


def update_marts(
    spark: SparkSession,
    target: Target | str,
    marts_root: str,
    event_types: tuple[str, ...] = EVENT_TYPES,
    stages: tuple[str, ...] = FUNNEL_STAGES,
) -> dict:
    """Bring the three tables up to the published clean table; returns the
    loads that were read and the dates that were written (None: all).

    Only loads without a partial are read. Their dates are rolled up again from the
    partials of all loads; after a full refresh, or for other event types or stages,
    all dates are, still from partials. A merge of loads changes nothing, unless
    the loads it merged were vacuumed before this function had seen them: the merged
    load is then read. A crash leaves the state as it was, and the next call does the
    same dates over. Let one caller at a time update the tables; of two the
    later one fails (``ConflictingRun``), and another call puts right what they wrote."""
    t = target if isinstance(target, Target) else Target(target)
    number, state = _state(spark, marts_root)
    there = set(list_dirs(spark, t.data))
    ledger = t.ledger(spark)
    for loads in (original_loads(ledger), ledger.committed_loads()):
        parts = [p for p in state["parts"] if set(p["loads"]) <= set(loads)]
        held = {x for p in parts for x in p["loads"]}
        fresh = [x for x in loads if x not in held]
        if all(f"load={x}" in there for x in fresh):
            break
    spec = {"event_types": list(event_types), "stages": list(stages)}
    whole = number < 0 or not set(state["shown"]) <= set(loads) or any(state[k] != v for k, v in spec.items())
    if not fresh and not whole:
        return {"loads": [], "dates": []}
    dates = []
    if fresh:
        part = _write_part(marts_root, partial_events(read_loads(spark, t, fresh)), fresh, 0)
        dates = _dates(spark, _part_path(marts_root, part))
        parts = _merge_levels(spark, marts_root, [*parts, part])
    rows = _read_parts(spark, marts_root, parts)
    _publish(spark, marts_root, rows if whole else rows.filter(F.col("event_date").isin(dates)), event_types, stages, whole)
    text = json.dumps({"parts": parts, "shown": loads, **spec})
    if not put_if_absent(spark, _state_file(marts_root, number + 1), text):
        raise ConflictingRun(f"the summary tables of {marts_root} were updated by another caller")
    used = {f"part={p['id']}" for p in parts}
    for d in list_dirs(spark, f"{marts_root}/_partials"):
        if d not in used:  # merged, of loads no longer published, or left by a crash
            delete_path(spark, f"{marts_root}/_partials/{d}")
    delete_path(spark, _state_file(marts_root, number - 1))
    return {"loads": fresh, "dates": None if whole else dates}
