"""Run ledger: a numbered log of runs per target, with snapshots.

Every run ends in one log entry, ``<path>/<number>.json``: counts, duration,
status, the increment bounds and the folder it wrote. The entry is the
run's commit:

* the high-water mark of a name is ``hwm_high`` of the latest entry that
  sets it (``sets_mark``; a reset sets it to null);
* the published table is the latest successful full snapshot plus every
  successful increment committed after it.

Commits are optimistic. A run remembers the number of the last entry it has
read and works without holding anything. At its end it puts its entry under the next
free number, if absent (``fs.put_if_absent``): of several writers one gets
it. The others read what was committed meanwhile: an entry that changes what
the run was based on (see ``conflict``) makes the run fail with ``ConflictingRun``; past
others the run takes the number after them. A run that is killed leaves no entry and so blocks nobody.

Every ``SNAPSHOT_EVERY`` entries the log is summed up: all rows in one Parquet
file for the history, and the state, marks and loads, in one small file. Entries well before
it are deleted, so a run lists and reads a bounded number of files. No Spark job is
needed to read the state.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.fs import delete_path, list_dirs, list_files, put_if_absent, read_text

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("job_type", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_before_filtering", T.LongType()),
        T.StructField("rows_after_filtering", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("hwm_name", T.StringType()),
        T.StructField("hwm_low", T.TimestampNTZType()),
        T.StructField("hwm_high", T.TimestampNTZType()),
        T.StructField("sets_mark", T.BooleanType()),
        T.StructField("load", T.StringType()),
        T.StructField("batch", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("deliver", T.BooleanType()),
        T.StructField("kept", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Fixed value: run history returns 20 runs by default.
HISTORY_DEFAULT = 20

FULL = "full_snapshot"
INCREMENTAL = "incremental"
RESET = "hwm_reset"
BATCH = "stream_batch"
MERGE = "merge"
DELIVERY = "delivery"
SUCCESS = "success"
FAILED = "failed"

# Entries between two snapshots, and how many older ones stay for writers that read the log before.
SNAPSHOT_EVERY = 16
KEEP = 64


class ConflictingRun(RuntimeError):
    """What the run was based on was changed by a run that committed first."""


def conflict(row: dict, other: dict) -> str | None:
    """Why ``row`` cannot follow ``other``, committed since its run began;
    None if it can."""
    job = row["job_type"]
    if row["status"] != SUCCESS or other["status"] != SUCCESS or job in (RESET, DELIVERY):
        return None
    if job == BATCH and other["job_type"] == BATCH and row["batch"] == other["batch"]:
        return f"batch {row['batch']} was loaded"
    if job == INCREMENTAL:
        if other["sets_mark"] and other["hwm_name"] == row["hwm_name"]:
            return f"the mark {row['hwm_name']} was moved"
        if other["job_type"] == FULL:
            return "a full refresh was published"
    # a snapshot hides all loads before it: none may have come in that it has not seen
    if job in (FULL, MERGE) and other.get("load"):
        return f"the load {other['load']} was published"
    return None


@dataclass
class State:
    """What the log says up to entry ``last``."""

    last: int = -1
    marks: dict[str, list] = field(default_factory=dict)  # name: [high as text, number]
    loads: list[str] = field(default_factory=list)
    undelivered: list[str] = field(default_factory=list)
    emptying: list[str] = field(default_factory=list)  # of these, the full snapshots
    kept: dict[str, str] = field(default_factory=dict)  # <what>@<mark>: what runs left for later ones
    history: str = ""  # the folder of a snapshot's rows

    def add(self, number: int, row: dict) -> None:
        self.last = number
        if row["status"] != SUCCESS:
            return
        if row["sets_mark"]:
            name = row["hwm_name"]
            self.marks[name] = [row["hwm_high"], number]
            # an entry that sets a mark names all that is kept for it from then on
            self.kept = {k: v for k, v in self.kept.items() if not k.endswith(f"@{name}")} | (row.get("kept") or {})
        if row["job_type"] == DELIVERY:
            self.undelivered = [x for x in self.undelivered if x != row["batch"]]
        elif row["load"] is not None:
            if row["job_type"] in (FULL, MERGE):
                self.loads = []
            self.loads.append(row["load"])
            if row.get("deliver"):
                if row["job_type"] == FULL:  # empties the table first
                    self.undelivered, self.emptying = [], [row["load"]]
                self.undelivered.append(row["load"])

    def mark(self, name: str | None) -> tuple[dt.datetime | None, int | None]:
        """(mark, number of the entry that set it), of the last set if unnamed."""
        known = [self.marks[name]] if name in self.marks else sorted(self.marks.values(), key=lambda m: m[1]) if name is None else []
        if not known:
            return None, None
        high, number = known[-1]
        return None if high is None else dt.datetime.fromisoformat(high), number


def _encoded(value):
    return value.isoformat() if isinstance(value, dt.datetime) else value


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _entry(self, number: int) -> str:
        return f"{self.path}/{number:012d}.json"

    def _numbers(self) -> tuple[list[int], list[int]]:
        """Numbers of the entries and of the snapshots there are."""
        names = [f.rsplit("/", 1)[1] for f in list_files(self.spark, self.path)]
        entries = sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.endswith(".state.json"))
        return entries, sorted(int(n[:-11]) for n in names if n.endswith(".state.json"))

    def _row(self, number: int) -> dict:
        return json.loads(read_text(self.spark, self._entry(number)))

    def _snapshot(self, number: int) -> State:
        return State(**json.loads(read_text(self.spark, f"{self.path}/{number:012d}.state.json")))

    def current(self) -> State:
        """The state now: the last snapshot and the entries after it."""
        entries, snapshots = self._numbers()
        state = self._snapshot(snapshots[-1]) if snapshots else State()
        for n in entries:
            if n > state.last:
                state.add(n, self._row(n))
        return state

    def commit(self, row: dict, read: int | None = None) -> int:
        """Append ``row``, from a run that has read the log up to ``read``
        (default: everything), and return its number; ``ConflictingRun`` if it
        cannot follow what was committed since."""
        row = {f.name: _encoded(row.get(f.name)) for f in LEDGER_SCHEMA.fields if f.name != "seq"}
        state = self.current()
        number = state.last + 1
        since = state.last if read is None else read
        while True:
            for n, other in self._committed(since, number):
                why = conflict(row, other)
                if why:
                    raise ConflictingRun(f"{row['run_id']} cannot be committed: {why} by run {n}")
            since = number - 1
            if put_if_absent(self.spark, self._entry(number), json.dumps({"seq": number, **row})):
                break
            number += 1
        entries, snapshots = self._numbers()
        if snapshots and snapshots[-1] - KEEP > number:
            delete_path(self.spark, self._entry(number))  # taken and summed up long ago: the writer slept
            return self.commit(row, since)
        if number + 1 - (snapshots[-1] + 1 if snapshots else 0) >= SNAPSHOT_EVERY:
            self.snapshot()
        return number

    def _committed(self, since: int, until: int) -> list[tuple[int, dict]]:
        """Entries after ``since`` and before ``until``; those deleted since, from the history."""
        numbers = range(since + 1, until)
        there = set(self._numbers()[0]) if numbers else set()
        found = [(n, self._row(n)) for n in numbers if n in there]
        if len(found) < len(numbers):
            old = self.runs().filter(F.col("seq").between(since + 1, until - 1)).collect()
            found += [(r["seq"], r.asDict()) for r in old if r["seq"] not in there]
        return sorted(found, key=lambda e: e[0])

    def append(self, row: dict) -> int:
        return self.commit(row)

    def _tail(self, numbers: list[int]) -> DataFrame:
        text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else f.dataType) for f in LEDGER_SCHEMA.fields])
        rows = self.spark.read.schema(text).json([self._entry(n) for n in numbers])
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA.fields])

    def runs(self) -> DataFrame:
        """One row per run."""
        entries, snapshots = self._numbers()
        last = snapshots[-1] if snapshots else -1
        tail = [n for n in entries if n > last]
        parts = [self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.path}/history/{self._snapshot(last).history}")] if snapshots else []
        parts += [self._tail(tail)] if tail else []
        if not parts:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def snapshot(self) -> int:
        """Sum up the log so far; returns the number of files and folders deleted. The
        snapshot is complete before it counts, and counts before anything is
        deleted; of two writers of the same one the first one's counts."""
        entries, snapshots = self._numbers()
        state = self.current()
        if state.last < 0 or (snapshots and state.last == snapshots[-1]):
            return 0
        state.history = f"{state.last:012d}-{uuid.uuid4().hex}"
        self.runs().filter(F.col("seq") <= state.last).coalesce(1).write.parquet(f"{self.path}/history/{state.history}")
        if not put_if_absent(self.spark, f"{self.path}/{state.last:012d}.state.json", json.dumps(state.__dict__)):
            delete_path(self.spark, f"{self.path}/history/{state.history}")
            return 0
        # the snapshot before stays for readers that have just seen it
        before = snapshots[-1] if snapshots else 0
        gone = [self._entry(n) for n in entries if n < state.last - KEEP] + [f"{self.path}/{n:012d}.state.json" for n in snapshots[:-1]]
        gone += [f"{self.path}/history/{d}" for d in list_dirs(self.spark, f"{self.path}/history") if int(d.split("-")[0]) < before]
        for f in gone:
            delete_path(self.spark, f)
        return len(gone)

    def has_batch(self, batch: str) -> bool:
        return not self.runs().filter((F.col("batch") == batch) & (F.col("job_type") == BATCH) & (F.col("status") == SUCCESS)).isEmpty()

    def state(self, hwm_name: str | None = None) -> tuple[int, dt.datetime | None, int | None]:
        """(next number, current mark of ``hwm_name``, number of the entry that
        set it - None while none ever has)."""
        now = self.current()
        return now.last + 1, *now.mark(hwm_name)

    def committed_loads(self) -> list[str]:
        """Loads of the published table, oldest first: the last snapshot or
        merge and what was committed after it. ``jobs.merge_loads`` keeps
        the list short."""
        return self.current().loads

    def history(self, limit: int = HISTORY_DEFAULT) -> DataFrame:
        """The latest ``limit`` runs, newest first."""
        if limit < 1:
            raise ValueError("limit must be at least 1")
        return self.runs().orderBy(F.desc("seq")).limit(limit)

    def status(self, run_id: str) -> DataFrame:
        """The run ``run_id``; an unknown id raises ``KeyError``."""
        found = self.runs().filter(F.col("run_id") == run_id)
        if found.isEmpty():
            raise KeyError(f"run {run_id} not found")
        return found
