"""Composite jobs: full refresh, incremental load, preview, mark reset.

Target layout under one root folder::

    <root>/_runs/                         run ledger (commit log, marks)
    <root>/data/load=<id>/event_date=<d>/  one folder per run, named by run id
    <root>/kept/<name>-<run id>/          what a run keeps for later ones

A run writes a folder that nobody else writes and commits by one entry of
the ledger, unless a run that committed meanwhile changed what it was based on; the
entry is also its result. Counts are exact however often tasks or stages run again: rows in
come from an aggregate over the frozen batch, rows written from the footers of the
committed load. With a database target the committed loads are then delivered there
(``deliver``). While the source grows in place and ``stage`` is not set, rows that
arrive late between the passes of a run can be in some of its counts only.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.fs import delete_path, list_dirs
from clickweir.functions import wall_clock
from clickweir.observe import observed as observed_metrics
from clickweir.operators.clean import clean_events
from clickweir.operators.enrich import enrich
from clickweir.operators.filters import require_columns
from clickweir.operators.traffic_cap import DEFAULT_CAPS, Caps, Violators, find_violators, key_counts, merged_counts, violators_with_history, written_violators
from clickweir.plans.ledger import BATCH, DELIVERY, FAILED, FULL, INCREMENTAL, MERGE, RESET, SUCCESS, Ledger
from clickweir.schema import TARGET_COLUMNS, TARGET_SCHEMA
from clickweir.session import work_path
from clickweir.sources.jdbc import delete_load_jdbc, write_jdbc
from clickweir.sources.table import write_clean_table

# The mark's column and name.
HWM_COLUMN = "event_time"
HWM_NAME = "clickstream_event_time_hwm"

# The columns a preview shows.
PREVIEW_COLUMNS = ("event_time", "event_type", "product_id", "category_code", "event_date", "event_hour", "day_of_week")


@dataclass(frozen=True)
class Target:
    """Where a job's rows go. ``jdbc``: options of a database table that also
    receives them, once each, after the run has committed (``deliver``); a
    full refresh empties it first, keeping its DDL. The table has a column
    ``jdbc_load_column`` more, which holds the load a row came with."""

    root: str
    jdbc: dict[str, str] | None = None
    jdbc_connections: int | None = None
    jdbc_load_column: str = "load_id"
    jdbc_writer: Callable = field(default=write_jdbc, compare=False)
    jdbc_deleter: Callable = field(default=delete_load_jdbc, compare=False)

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    @property
    def kept(self) -> str:
        return f"{self.root}/kept"

    @property
    def runs(self) -> str:
        return f"{self.root}/_runs"

    def load_path(self, load: str) -> str:
        return f"{self.data}/load={load}"

    def ledger(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, self.runs)


def _as_target(target: Target | str) -> Target:
    return target if isinstance(target, Target) else Target(target)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def mark_literal(value: dt.datetime, dtype: T.DataType) -> Column:
    """A mark (a wall-clock value, see ``wall_clock``) as a literal of the
    source column's type. Built from text: for TIMESTAMP_NTZ it never
    passes through a zone; for TIMESTAMP it is read in the session zone,
    the zone the mark was taken in."""
    text = F.lit(value.isoformat(sep=" "))
    return text.cast("timestamp_ntz") if isinstance(dtype, T.TimestampNTZType) else text.cast(dtype)


def require_utc(source: DataFrame, hwm_column: str = HWM_COLUMN) -> None:
    """The calendar fields, minutes and marks of a zoned event time follow the
    session zone; the jobs define them in UTC and refuse another one."""
    zone = source.sparkSession.conf.get("spark.sql.session.timeZone")
    if isinstance(source.schema[hwm_column].dataType, T.TimestampType) and zone not in ("UTC", "GMT", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"{hwm_column} has a zone and the session's zone is {zone}: set spark.sql.session.timeZone to UTC")


def stage_rows(source: DataFrame) -> tuple[DataFrame, str]:
    """Copy ``source`` once to the shared folder; later passes read the copy.

    For a database source this is the only query the job sends, and every
    count, the mark and the written rows then refer to the same snapshot.
    """
    path = work_path(source.sparkSession, "stage")
    source.write.parquet(path)
    return source.sparkSession.read.schema(source.schema).parquet(path), path


def read_table(spark: SparkSession, target: Target | str) -> DataFrame:
    """The published clean table: committed loads only."""
    t = _as_target(target)
    return read_loads(spark, t, t.ledger(spark).committed_loads())


def read_loads(spark: SparkSession, t: Target, loads: list[str]) -> DataFrame:
    """The rows of some loads."""
    if not loads:
        return spark.createDataFrame([], TARGET_SCHEMA)
    schema = T.StructType(TARGET_SCHEMA.fields + [T.StructField("load", T.StringType())])
    reader = spark.read.schema(schema).option("basePath", t.data)
    return reader.parquet(*[t.load_path(x) for x in loads]).select(*TARGET_COLUMNS)


def vacuum(spark: SparkSession, target: Target | str) -> list[str]:
    """Delete the folders of loads readers no longer see (superseded
    snapshots, increments before them, failed attempts), but not of those the
    database still has to get, and sum up the ledger; returns the folders' names. Run it only while no job
    writes to the target, and when no reader still scans an older snapshot."""
    t = _as_target(target)
    ledger = t.ledger(spark)
    now = ledger.current()
    visible = {f"load={x}" for x in (*now.loads, *now.undelivered)}
    gone = [d for d in list_dirs(spark, t.data) if d.startswith("load=") and d not in visible]
    for d in gone:
        delete_path(spark, f"{t.data}/{d}")
    for d in list_dirs(spark, t.kept):
        if d not in now.kept.values():
            delete_path(spark, f"{t.kept}/{d}")
    ledger.snapshot()
    return gone


def deliver(spark: SparkSession, target: Target | str) -> list[str]:
    """Send the committed loads that the database has not got yet, oldest
    first; returns their names. That a load was sent is an entry of the
    ledger. A load without one may have been sent in part by a run that then failed: what
    the database holds of it is deleted before it is sent again, so every load ends up
    there exactly once. Let one caller at a time deliver."""
    t = _as_target(target)
    if t.jdbc is None:
        return []
    ledger = t.ledger(spark)
    now = ledger.current()
    for name in now.undelivered:
        rows = spark.read.schema(TARGET_SCHEMA).parquet(t.load_path(name)).select(*TARGET_COLUMNS, F.lit(name).alias(t.jdbc_load_column))
        empty = name in now.emptying
        if not empty:
            t.jdbc_deleter(spark, t.jdbc, t.jdbc_load_column, name)
        t.jdbc_writer(rows, t.jdbc, mode="overwrite" if empty else "append", truncate=empty, max_connections=t.jdbc_connections)
        ledger.append({"run_id": uuid.uuid4().hex, "job_type": DELIVERY, "status": SUCCESS, "started_at": _now(), "finished_at": _now(), "batch": name})
    return now.undelivered


class _Run:
    """One run on a target: what it has read of the ledger, its folder, its
    entry and what it must delete. The entry is the run's only record."""

    def __init__(self, spark: SparkSession, target: Target, job_type: str, hwm_name: str | None = None, batch: str | None = None):
        self.spark, self.target, self.ledger = spark, target, target.ledger(spark)
        self.clock, self.scratch = time.time(), []
        self.read = self.ledger.current()
        self.mark, _ = self.read.mark(hwm_name)
        self.row = {"run_id": uuid.uuid4().hex, "job_type": job_type, "started_at": _now(), "hwm_name": hwm_name, "batch": batch}

    def __enter__(self) -> _Run:
        return self

    def __exit__(self, kind, exc, trace) -> None:
        if exc is not None:
            self.ledger.append({**self.row, "status": FAILED, "finished_at": _now(), "error": repr(exc)})
        for path in self.scratch:
            delete_path(self.spark, path)

    def staged(self, rows: DataFrame, stage: bool) -> DataFrame:
        if not stage:
            return rows
        copy, path = stage_rows(rows)
        self.scratch.append(path)
        return copy

    def violators(self, rows: DataFrame, caps: Caps) -> Violators:
        path = work_path(self.spark, "violators")
        self.scratch.append(path)
        return find_violators(rows, caps, path)

    def write(self, cleaned: DataFrame, time_ordered: bool, time_ranges: bool = False) -> int:
        """Write the run's load; rows written."""
        self.row["load"] = f"{self.row['job_type']}-{self.row['run_id']}"
        self.row["deliver"] = self.target.jdbc is not None
        path = self.target.load_path(self.row["load"])
        write_clean_table(cleaned, path, mode="errorifexists", time_ordered=time_ordered, time_ranges=time_ranges)
        return self.spark.read.schema(TARGET_SCHEMA).parquet(path).count()  # of no column: read from the files' footers

    def keep(self, what: str, rows: DataFrame) -> str:
        """Write a table that later runs of the mark read once this one has
        committed, and return its path. What is not kept again by the next run
        that sets the mark is gone from then on."""
        folder = f"{what}-{self.row['run_id']}"
        rows.write.parquet(f"{self.target.kept}/{folder}")
        self.note(folder, folder)
        return f"{self.target.kept}/{folder}"

    def note(self, what: str, value: str) -> None:
        self.row["kept"] = {**(self.row.get("kept") or {}), f"{what}@{self.row['hwm_name']}": value}

    def noted(self, what: str) -> list[str]:
        """Values that were kept for the mark under names that begin so."""
        end = f"@{self.row['hwm_name']}"
        return [v for k, v in self.read.kept.items() if k.startswith(what) and k.endswith(end)]

    def kept(self, what: str) -> list[DataFrame]:
        return [self.spark.read.parquet(f"{self.target.kept}/{folder}") for folder in self.noted(f"{what}-")]

    def violators_of_history(self, rows: DataFrame, caps: Caps) -> Violators:
        """Keys over their caps in this batch and all before it. The batch's
        counts are kept beside those of earlier loads; every ``COUNT_PARTS`` loads
        they are merged into one table."""
        own = self.spark.read.parquet(self.keep("counts", key_counts(rows)))
        before = self.kept("counts")
        path = work_path(self.spark, "violators")
        self.scratch.append(path)
        found = written_violators(violators_with_history(own, before, caps), path)
        if len(before) >= COUNT_PARTS:
            self.row["kept"] = {k: v for k, v in self.row["kept"].items() if not k.startswith("counts-")}
            self.keep("counts-merged", merged_counts([own, *before]))
        else:
            for folder in self.noted("counts-"):
                self.note(folder, folder)
        return found

    def commit(self, rows_in: int, rows_out: int, **row) -> dict:
        self.row |= {
            "status": SUCCESS, "finished_at": _now(), "duration_seconds": round(time.time() - self.clock, 2),
            "rows_read": rows_in, "rows_before_filtering": rows_in, "rows_after_filtering": rows_out, "rows_written": rows_out, **row,
        }
        self.ledger.commit(self.row, self.read.last)
        return {k: self.row[k] for k in RESULT_FIELDS}


# Tables of counts that loads leave before they are merged.
COUNT_PARTS = 8
# Scopes of the caps: the rows of a batch, or of all batches of the mark so far.
BATCH_SCOPE = "batch"
HISTORY_SCOPE = "history"


def row_keys(rows: DataFrame) -> DataFrame:
    """``rows`` with two hashes of all their columns (``key_a``, ``key_b``)."""
    # a null leaves such a hash as it is, so the places of nulls are hashed too
    columns = [c for name in rows.columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return rows.withColumns({"key_a": F.xxhash64(*columns), "key_b": F.xxhash64(F.lit(7), *columns)})


def seen_rows(rows: DataFrame, hwm_column: str = HWM_COLUMN) -> DataFrame:
    """(seen_at, key_a, key_b, n): how often each row of the batch occurs."""
    return row_keys(rows).groupBy(wall_clock(hwm_column).alias("seen_at"), "key_a", "key_b").agg(F.count(F.lit(1)).alias("n"))


def not_seen(rows: DataFrame, seen: list[DataFrame]) -> DataFrame:
    """Multiset difference: each row as often as ``rows`` hold it more than
    ``seen`` counts it. Rows are counted before they are moved, so one row that is
    repeated very often is one row of the shuffle."""
    before = _union(seen).groupBy("key_a", "key_b").agg(F.sum("n").alias("seen"))
    counted = row_keys(rows).groupBy("key_a", "key_b", *rows.columns).agg(F.count(F.lit(1)).alias("held"))
    more = F.col("held") - F.coalesce("seen", F.lit(0))
    left = counted.join(before, ["key_a", "key_b"], "left").withColumn("more", more).filter("more > 0")
    return left.select(*rows.columns, F.explode(F.array_repeat(F.lit(1), F.col("more").cast("int"))).alias("copy")).drop("copy")


# Fields of a ledger row that a job returns.
RESULT_FIELDS = (
    "run_id", "job_type", "status", "duration_seconds", "rows_read", "rows_before_filtering", "rows_after_filtering", "rows_written",
)


def _row_count(rows: DataFrame) -> int:
    """An aggregate over the rows: exact even if its stages run again."""
    return rows.agg(F.count(F.lit(1))).first()[0]


def run_full(
    spark: SparkSession,
    source: DataFrame,
    target: Target | str,
    caps: Caps = DEFAULT_CAPS,
    set_hwm: bool = False,
    hwm_name: str = HWM_NAME,
    hwm_column: str = HWM_COLUMN,
    time_ordered: bool = False,
    stage: bool = False,
    vacuum_after: bool = False,
    time_ranges: bool = False,
) -> dict:
    """Full refresh: clean the whole source into a new load, then publish
    it by one ledger append. Readers see the previous snapshot until then,
    never an empty table. The mark is left alone unless ``set_hwm``.
    ``time_ordered``, ``time_ranges``: see ``write_clean_table``; ``stage``: see
    ``stage_rows`` (for database sources); ``vacuum_after`` frees the superseded loads
    once the new snapshot is published (see ``vacuum``)."""
    t = _as_target(target)
    require_utc(source, hwm_column)
    with _Run(spark, t, FULL, hwm_name) as run:
        rows = run.staged(source, stage)
        cleaned = clean_events(rows, caps, violators=run.violators(require_columns(rows), caps))
        written = run.write(cleaned, time_ordered, time_ranges)
        high = rows.agg(F.max(wall_clock(hwm_column))).first()[0] if set_hwm else None
        result = run.commit(_row_count(rows), written, hwm_high=high, sets_mark=set_hwm)
    deliver(spark, t)
    if vacuum_after:
        vacuum(spark, t)
    return result


def increment_bounds(
    source: DataFrame, low: dt.datetime | None, hwm_column: str = HWM_COLUMN
) -> tuple[DataFrame, dt.datetime | None]:
    """Rows above ``low`` and the batch's upper bound ``high`` = their max.

    ``high`` is frozen here, so the batch is ``(low, high]`` even if the
    source grows while the job runs; both bounds reach the scan as pushed
    filters. With no mark, the batch is everything up to ``high``.
    """
    col = F.col(hwm_column)
    dtype = source.schema[hwm_column].dataType
    above = source if low is None else source.filter(col > mark_literal(low, dtype))
    high = above.agg(F.max(wall_clock(col)).alias("high")).first()["high"]
    if high is None:
        return above.limit(0), None
    return above.filter(col <= mark_literal(high, dtype)), high


def _bounded_batch(
    source: DataFrame, low: dt.datetime | None, caps: Caps, hwm_column: str, find: Callable[[DataFrame, Caps], Violators]
) -> tuple[DataFrame, dt.datetime | None, Violators | None]:
    """(batch, high, violators): the bound is observed on the violator pass
    (a maximum does not change if tasks run again) and the batch is frozen
    to ``(low, high]``, so every later pass sees the same rows."""
    col = F.col(hwm_column)
    dtype = source.schema[hwm_column].dataType
    above = source.filter(col.isNotNull() if low is None else col > mark_literal(low, dtype))
    stats = Observation()
    violators = find(require_columns(above.observe(stats, F.max(wall_clock(col)).alias("high"))), caps)
    got = observed_metrics(stats)
    high = got["high"] if got is not None else above.agg(F.max(wall_clock(col)).alias("h")).first()["h"]
    if high is None:
        return above.limit(0), None, None
    return above.filter(col <= mark_literal(high, dtype)), high, violators


def run_incremental(
    spark: SparkSession,
    source: DataFrame,
    target: Target | str,
    caps: Caps = DEFAULT_CAPS,
    hwm_name: str = HWM_NAME,
    hwm_column: str = HWM_COLUMN,
    time_ordered: bool = False,
    stage: bool = False,
    lateness: dt.timedelta | None = None,
    scope: str = BATCH_SCOPE,
) -> dict:
    """Load the rows after the saved mark, then commit rows and mark together.

    Each run writes a folder of its own; only the committed one is read, so
    a retry after a crash loads no batch twice; runs of other marks commit
    beside it, one of the same mark makes it fail (``ConflictingRun``).
    No new rows: zero counts, no write, mark unchanged. ``stage`` copies
    the batch once first (see ``stage_rows``; for database sources).

    ``lateness``: rows that arrive late, at or under the mark but less than this before
    it, are loaded too, once. Each run keeps how often it has seen each row
    of that time; the next one reads the time again and takes what occurs more
    often, so repeats that are legal stay. It takes effect for the time that
    runs with it have covered without a gap.

    ``scope``: the rows the caps count, those of this batch (``BATCH_SCOPE``) or
    of all batches of the mark since it was first set with ``HISTORY_SCOPE``, too. Rows
    loaded by earlier batches stay.
    """
    if scope not in (BATCH_SCOPE, HISTORY_SCOPE):
        raise ValueError(f"unknown scope {scope!r}")
    t = _as_target(target)
    require_utc(source, hwm_column)
    with _Run(spark, t, INCREMENTAL, hwm_name) as run:
        low = run.row["hwm_low"] = run.mark
        col, dtype = F.col(hwm_column), source.schema[hwm_column].dataType
        if low is None:  # from the beginning: nothing was seen or counted before
            run.read.kept = {}
        above = source.filter(col.isNotNull() if low is None else col > mark_literal(low, dtype))
        seen = run.kept("seen")
        if lateness is not None and low is not None and seen:
            covered = dt.datetime.fromisoformat(run.noted("since")[0])
            since = max(covered, low - lateness)
            again = source.filter((col > mark_literal(since, dtype)) & (col <= mark_literal(low, dtype)))
            above = above.unionByName(run.staged(not_seen(again, seen), True))
        find = run.violators_of_history if scope == HISTORY_SCOPE else run.violators
        batch, high, violators = _bounded_batch(run.staged(above, stage), None, caps, hwm_column, find)
        if high is None:
            run.row.pop("kept", None)
            return run.commit(0, 0, sets_mark=False)
        high = high if low is None else max(low, high)
        written = run.write(clean_events(batch, caps, violators=violators), time_ordered)
        if lateness is not None:
            since = high - lateness
            if low is not None:
                since = max(since, dt.datetime.fromisoformat(run.noted("since")[0]) if seen else low)
            parts = [*seen, seen_rows(batch, hwm_column)]
            run.keep("seen", _union(parts).filter(F.col("seen_at") > mark_literal(since, T.TimestampNTZType())).groupBy("seen_at", "key_a", "key_b").agg(F.sum("n").alias("n")))
            run.note("since", since.isoformat())
        result = run.commit(_row_count(batch), written, hwm_high=high, sets_mark=True)
    deliver(spark, t)
    return result


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_batch(
    spark: SparkSession,
    rows: DataFrame,
    target: Target | str,
    batch: str,
    caps: Caps = DEFAULT_CAPS,
    time_ordered: bool = False,
) -> dict | None:
    """Load all of ``rows`` as the batch of that name, once: a name the
    ledger holds as committed is skipped (None). Marks play no part."""
    t = _as_target(target)
    require_utc(rows)
    if t.ledger(spark).has_batch(batch):
        return None
    with _Run(spark, t, BATCH, batch=batch) as run:
        copy = run.staged(rows, True)  # a micro-batch is read once
        written = run.write(clean_events(copy, caps, violators=run.violators(require_columns(copy), caps)), time_ordered)
        result = run.commit(_row_count(copy), written)
    deliver(spark, t)
    return result


def merge_loads(spark: SparkSession, target: Target | str) -> dict:
    """Rewrite the published table, a snapshot and the small loads after it,
    as one load, whose files of a date do not overlap in time (``time_ranges``).
    Rows and marks stay as they are; ``vacuum`` then frees the merged loads."""
    t = _as_target(target)
    with _Run(spark, Target(t.root), MERGE) as run:
        rows = read_table(spark, t)
        written = run.write(rows, time_ordered=False, time_ranges=True)
        return run.commit(written, written)


def reset_mark(spark: SparkSession, target: Target | str, hwm_name: str = HWM_NAME) -> None:
    """Forget the mark: the next increment starts from the beginning."""
    with _Run(spark, _as_target(target), RESET, hwm_name) as run:
        run.ledger.commit({**run.row, "status": SUCCESS, "finished_at": _now(), "sets_mark": True}, run.read.last)


@dataclass
class Preview:
    rows_read: int
    rows_after_filtering: int
    max_event_time: dt.datetime | None
    first_rows: DataFrame


def preview_increment(
    spark: SparkSession,
    source: DataFrame,
    target: Target | str,
    caps: Caps = DEFAULT_CAPS,
    n: int = 10,
    hwm_name: str = HWM_NAME,
    hwm_column: str = HWM_COLUMN,
) -> Preview:
    """Counts, new max time and the first ``n`` rows (by time) of the next
    increment, in two passes over the batch: the violator pass, and the
    pass for the first rows, on which counts and time are observed."""
    require_utc(source, hwm_column)
    low, _ = _as_target(target).ledger(spark).current().mark(hwm_name)
    scratch = work_path(spark, "violators")
    try:
        batch, high, violators = _bounded_batch(source, low, caps, hwm_column, lambda rows, c: find_violators(rows, c, scratch))
        if high is None:
            return Preview(0, 0, None, enrich(batch).select(*PREVIEW_COLUMNS).limit(0))
        before, after = Observation(), Observation()
        seen = batch.observe(before, F.count(F.lit(1)).alias("rows"))
        cleaned = clean_events(seen, caps, violators=violators).observe(
            after, F.count(F.lit(1)).alias("rows"), F.max(wall_clock(hwm_column)).alias("max_time")
        )
        shown = cleaned.select(*PREVIEW_COLUMNS)
        first = shown.orderBy(*PREVIEW_COLUMNS).limit(n).collect()
        got_in, got_out = observed_metrics(before) or {"rows": 0}, observed_metrics(after) or {"rows": 0, "max_time": None}
        return Preview(int(got_in["rows"]), int(got_out["rows"]), got_out["max_time"], spark.createDataFrame(first, shown.schema))
    finally:
        delete_path(spark, scratch)
