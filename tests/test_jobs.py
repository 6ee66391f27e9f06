"""Full refresh, increments, marks, ledger: the reference's manual run
book as automated tests, plus crash/retry behaviour."""

import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clickweir.operators import Caps, clean_events
from clickweir.plans import jobs
from clickweir.plans.jobs import (
    Target,
    preview_increment,
    read_table,
    reset_mark,
    run_full,
    run_incremental,
)
from clickweir.fs import path_exists
from clickweir.plans import ledger as log
from clickweir.plans.ledger import ConflictingRun, Ledger
from clickweir.schema import SOURCE_SCHEMA, TARGET_COLUMNS
from clickweir.session import work_path
from clickweir.sources import clickstream_source
from conftest import SF_MID, SF_SMALL

SPLIT = dt.datetime(2024, 1, 15, 12, 0, 0)


def new_target(spark):
    return Target(work_path(spark, "test-target"))


def ntz(d):
    return F.lit(d.isoformat(sep=" ")).cast("timestamp_ntz")


def manual_row(spark, when):
    """The reference's hand-made row."""
    return spark.createDataFrame(
        [(when, "view", 888888888, 1, "manual.test.category", "manual_brand", Decimal("99.99"), 123456789,
          "manual-session-hwm-test")],
        SOURCE_SCHEMA,
    )


def test_run_book_scenario(spark):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    first = run_incremental(spark, src, target)
    assert first["rows_read"] == 989 and first["rows_after_filtering"] == 978
    assert read_table(spark, target).count() == 978
    second = run_incremental(spark, src, target)
    assert second == {**second, "rows_read": 0, "rows_written": 0}
    grown = src.unionByName(manual_row(spark, dt.datetime(2030, 1, 1, 0, 0, 0)))
    third = run_incremental(spark, grown, target)
    assert third["rows_read"] == 1 and third["rows_written"] == 1
    table = read_table(spark, target)
    assert table.count() == 979
    row = table.filter("product_id = 888888888").first()
    assert (row["category_level_1"], row["category_level_2"], row["category_level_3"]) == ("manual", "test", "category")


def test_one_batch_from_nothing_equals_full(spark):
    src = clickstream_source(spark, SF_SMALL)
    a, b = new_target(spark), new_target(spark)
    run_full(spark, src, a)
    run_incremental(spark, src, b)
    key = lambda r: (r["event_time"], r["product_id"], r["user_id"])
    assert sorted(read_table(spark, a).collect(), key=key) == sorted(read_table(spark, b).collect(), key=key)


def test_two_batches_count_only_their_rows(spark):
    """FIXTURES: caps 1/4, split at 12:00 -> 3,865 + 4,126 kept (full run keeps 7,951)."""
    src = clickstream_source(spark, SF_MID)
    target = new_target(spark)
    r1 = run_incremental(spark, src.filter(F.col("event_time") <= ntz(SPLIT)), target, Caps(1, 4))
    r2 = run_incremental(spark, src, target, Caps(1, 4))
    assert (r1["rows_written"], r2["rows_written"]) == (3865, 4126)
    assert read_table(spark, target).count() == 7991


def test_equal_time_row_is_not_read_again(spark):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    run_incremental(spark, src, target)
    _, mark, _ = target.ledger(spark).state(jobs.HWM_NAME)
    late = manual_row(spark, mark).unionByName(manual_row(spark, mark - dt.timedelta(days=1)))
    res = run_incremental(spark, src.unionByName(late), target)
    assert res["rows_read"] == 0


def test_retry_after_crash_before_commit_has_no_duplicates(spark, monkeypatch):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    real_commit = Ledger.commit
    calls = {"n": 0}

    def crashing_commit(self, record, read=None):
        calls["n"] += 1
        if record.get("status") == "success" and calls["n"] == 1:
            raise RuntimeError("driver lost after the write")
        return real_commit(self, record, read)

    monkeypatch.setattr(Ledger, "commit", crashing_commit)
    with pytest.raises(RuntimeError):
        run_incremental(spark, src, target)
    monkeypatch.setattr(Ledger, "commit", real_commit)
    # the data was written but not committed: readers and the mark ignore it
    assert read_table(spark, target).count() == 0
    assert target.ledger(spark).state(jobs.HWM_NAME)[1] is None
    runs = target.ledger(spark).runs().collect()
    assert [r["status"] for r in runs] == ["failed"]
    run_incremental(spark, src, target)
    assert read_table(spark, target).count() == 978


def test_full_refresh_swaps_and_survives_a_failed_run(spark, monkeypatch):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    run_full(spark, src, target)
    run_full(spark, src, target, Caps(1, 4))
    assert read_table(spark, target).count() == 806

    def boom(*a, **k):
        raise RuntimeError("executor lost for good")

    monkeypatch.setattr(jobs, "write_clean_table", boom)
    with pytest.raises(RuntimeError):
        run_full(spark, src, target)
    assert read_table(spark, target).count() == 806  # previous snapshot still published
    assert target.ledger(spark).runs().filter("status = 'failed'").count() == 1


def test_full_refresh_leaves_the_mark_unless_asked(spark):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    run_full(spark, src, target)
    assert target.ledger(spark).state(jobs.HWM_NAME)[1] is None
    run_full(spark, src, target, set_hwm=True)
    mark = target.ledger(spark).state(jobs.HWM_NAME)[1]
    assert mark == src.agg(F.max("event_time")).first()[0]
    assert run_incremental(spark, src, target)["rows_read"] == 0
    # full + increments after it are what readers see
    assert read_table(spark, target).count() == 978


def test_preview_does_not_move_the_mark(spark):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    run_incremental(spark, src.filter(F.col("event_time") <= ntz(SPLIT)), target)
    before = target.ledger(spark).state(jobs.HWM_NAME)
    p = preview_increment(spark, src, target)
    assert p.rows_read > 0 and p.first_rows.count() == 10
    assert target.ledger(spark).state(jobs.HWM_NAME) == before
    assert p.max_event_time == clean_events(src).agg(F.max("event_time")).first()[0]


def test_reset_mark_replays_everything(spark):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    run_incremental(spark, src, target)
    reset_mark(spark, target)
    assert target.ledger(spark).state(jobs.HWM_NAME)[1] is None
    assert run_incremental(spark, src, target)["rows_read"] == 989


def test_history_and_status(spark):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    ids = [run_incremental(spark, src, target)["run_id"] for _ in range(3)]
    ledger = target.ledger(spark)
    hist = ledger.history(2).collect()
    assert [r["run_id"] for r in hist] == ids[::-1][:2]
    assert ledger.history().count() == 3
    with pytest.raises(ValueError):
        ledger.history(0)
    assert ledger.history(51).count() == 3
    assert ledger.status(ids[0]).first()["rows_read"] == 989
    with pytest.raises(KeyError):
        ledger.status(uuid.uuid4().hex)


def test_staged_runs_equal_direct_runs(spark):
    src = clickstream_source(spark, SF_MID)
    first = src.filter(F.col("event_time") <= ntz(SPLIT))
    direct, staged = new_target(spark), new_target(spark)
    for t, stage in ((direct, False), (staged, True)):
        run_incremental(spark, first, t, Caps(1, 4), stage=stage)
        run_incremental(spark, src, t, Caps(1, 4), stage=stage)
        run_incremental(spark, src, t, Caps(1, 4), stage=stage)
    cols = ["seq", "hwm_low", "hwm_high", "rows_read", "rows_before_filtering", "rows_after_filtering", "rows_written"]
    assert direct.ledger(spark).runs().select(*cols).orderBy("seq").collect() == \
        staged.ledger(spark).runs().select(*cols).orderBy("seq").collect()
    a, b = new_target(spark), new_target(spark)
    ra = run_full(spark, src, a)
    rb = run_full(spark, src, b, stage=True)
    assert (ra["rows_before_filtering"], ra["rows_written"]) == (rb["rows_before_filtering"], rb["rows_written"]) == (10000, 9785)


def test_empty_source(spark):
    src = clickstream_source(spark, SF_SMALL).limit(0)
    target = new_target(spark)
    res = run_full(spark, src, target)
    assert (res["rows_before_filtering"], res["rows_written"]) == (0, 0)
    assert read_table(spark, target).count() == 0
    res = run_incremental(spark, src, target)
    assert res["rows_read"] == 0


def test_vacuum_frees_superseded_loads(spark):
    from clickweir.fs import list_dirs
    from clickweir.plans.jobs import vacuum

    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    run_incremental(spark, src.filter(F.col("event_time") <= ntz(SPLIT)), target)
    run_full(spark, src, target, set_hwm=True)  # increments continue after the snapshot
    run_incremental(spark, src.unionByName(manual_row(spark, dt.datetime(2030, 1, 1))), target)
    before = read_table(spark, target).count()
    assert before == 979
    (gone,) = vacuum(spark, target)
    assert gone.startswith("load=incremental-")
    assert read_table(spark, target).count() == before
    run_full(spark, src, target, vacuum_after=True)
    (left,) = list_dirs(spark, target.data)
    assert left.startswith("load=full_snapshot-")
    assert read_table(spark, target).count() == 978


def test_ledger_compaction_keeps_every_run(spark):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    for _ in range(3):
        run_incremental(spark, src, target)
    ledger = target.ledger(spark)
    before = sorted(ledger.runs().select("seq", "run_id", "rows_read").collect())
    ledger.snapshot()
    assert sorted(ledger.runs().select("seq", "run_id", "rows_read").collect()) == before
    assert ledger.snapshot() == 0
    assert read_table(spark, target).count() == 978
    assert run_incremental(spark, src, target)["rows_read"] == 0


def test_missing_source_column_is_a_clear_error(spark):
    src = clickstream_source(spark, SF_SMALL).drop("user_session")
    with pytest.raises(ValueError, match="user_session"):
        clean_events(src)


@pytest.fixture
def driver_zone_tokyo():
    """Run with the driver process in another zone than the session (UTC)."""
    import os
    import time

    old = os.environ.get("TZ")
    os.environ["TZ"] = "Asia/Tokyo"
    time.tzset()
    yield
    if old is None:
        os.environ.pop("TZ")
    else:
        os.environ["TZ"] = old
    time.tzset()


def test_zoned_timestamp_source_behaves_like_ntz(spark, driver_zone_tokyo):
    """A JDBC source delivers TIMESTAMP (zoned) instead of TIMESTAMP_NTZ."""
    ntz_src = clickstream_source(spark, SF_SMALL)
    ltz_src = ntz_src.withColumn("event_time", F.col("event_time").cast("timestamp"))
    key = lambda r: (r["event_time"], r["product_id"], r["user_id"], r["event_type"])
    a = sorted(clean_events(ntz_src, Caps(1, 4)).collect(), key=key)
    b = clean_events(ltz_src, Caps(1, 4)).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    b = sorted(b.collect(), key=key)
    assert len(a) == len(b) == 806
    assert [key(r) for r in a] == [key(r) for r in b]  # UTC session: same wall clock
    t1, t2 = new_target(spark), new_target(spark)
    for t, src in ((t1, ntz_src), (t2, ltz_src)):
        run_incremental(spark, src.filter(F.col("event_time") <= F.lit("2024-01-15 12:00:00").cast(src.schema["event_time"].dataType)), t)
        run_incremental(spark, src, t)
    cols = ["seq", "rows_read", "rows_written", "hwm_low", "hwm_high"]
    r1 = t1.ledger(spark).runs().select(*cols).orderBy("seq").collect()
    r2 = t2.ledger(spark).runs().select(*cols).orderBy("seq").collect()
    assert r1 == r2
    assert [r["rows_read"] for r in r1] == [503, 486]


def test_two_marks_on_one_target_keep_each_others_loads(spark):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    run_incremental(spark, src.filter(F.col("event_time") <= ntz(SPLIT)), target, hwm_name="a")
    n = read_table(spark, target).count()
    run_incremental(spark, src.filter(F.col("event_time") > ntz(SPLIT)), target, hwm_name="b")
    assert 0 < n < read_table(spark, target).count() == 978


def overlapped(monkeypatch, other):
    """Run ``other`` while the next run writes its load."""
    real = jobs.write_clean_table

    def overlapping(*a, **k):
        monkeypatch.setattr(jobs, "write_clean_table", real)
        other()
        return real(*a, **k)

    monkeypatch.setattr(jobs, "write_clean_table", overlapping)


def test_of_two_writers_of_one_mark_the_first_to_commit_wins(spark, monkeypatch):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    overlapped(monkeypatch, lambda: run_incremental(spark, src, target))
    with pytest.raises(ConflictingRun, match="mark"):
        run_incremental(spark, src, target)
    assert read_table(spark, target).count() == 978
    assert [r["status"] for r in target.ledger(spark).runs().orderBy("seq").collect()] == ["success", "failed"]
    assert run_incremental(spark, src, target)["rows_read"] == 0


def test_two_writers_of_two_marks_both_commit(spark, monkeypatch):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    late = F.col("event_time") > ntz(SPLIT)
    overlapped(monkeypatch, lambda: run_incremental(spark, src.filter(late), target, hwm_name="b"))
    run_incremental(spark, src.filter(~late), target, hwm_name="a")
    assert read_table(spark, target).count() == 978
    assert [r["status"] for r in target.ledger(spark).runs().collect()] == ["success", "success"]
    now = target.ledger(spark).current()
    assert now.marks["a"][1] == 1 and now.marks["b"][1] == 0


def test_a_load_that_a_merge_or_refresh_has_not_seen_is_not_hidden(spark, monkeypatch):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    run_incremental(spark, src.filter(F.col("event_time") <= ntz(SPLIT)), target)
    for job in (lambda: jobs.merge_loads(spark, target), lambda: run_full(spark, src, target)):
        before = read_table(spark, target).count()
        overlapped(monkeypatch, lambda: run_incremental(spark, manual_row(spark, dt.datetime(2030, 1, 1)), target, hwm_name=uuid.uuid4().hex))
        with pytest.raises(ConflictingRun, match="load"):
            job()
        assert read_table(spark, target).count() == before + 1


def test_a_killed_run_blocks_nobody(spark):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    run = jobs._Run(spark, target, jobs.INCREMENTAL, jobs.HWM_NAME)
    run.write(clean_events(src), False)  # and the driver dies here
    assert read_table(spark, target).count() == 0
    assert run_incremental(spark, src, target)["rows_written"] == 978
    assert read_table(spark, target).count() == 978
    assert len(jobs.vacuum(spark, target)) == 1


def test_the_ledger_reads_a_bounded_number_of_files(spark):
    target = new_target(spark)
    ledger = target.ledger(spark)
    n = log.SNAPSHOT_EVERY * 3 + log.KEEP + 5
    for i in range(n):
        row = {"run_id": f"r{i}", "job_type": jobs.INCREMENTAL, "status": "success", "hwm_name": f"m{i % 3}", "hwm_high": SPLIT + dt.timedelta(hours=i), "sets_mark": True, "load": f"l{i}"}
        assert ledger.commit(row, i - 3) == i
    entries, snapshots = ledger._numbers()
    assert len(entries) <= log.KEEP + 2 * log.SNAPSHOT_EVERY and len(snapshots) <= 2
    assert len([e for e in entries if e > snapshots[-1]]) < log.SNAPSHOT_EVERY
    assert [r["seq"] for r in ledger.runs().orderBy("seq").collect()] == list(range(n))
    assert ledger.state("m0")[1] == SPLIT + dt.timedelta(hours=max(i for i in range(n) if i % 3 == 0))
    assert ledger.committed_loads() == [f"l{i}" for i in range(n)]
    assert ledger.status("r1").first()["hwm_high"] == SPLIT + dt.timedelta(hours=1)
    # a run that began before the entries it has not read were summed up
    with pytest.raises(ConflictingRun):
        ledger.commit({"run_id": "old", "job_type": jobs.INCREMENTAL, "status": "success", "hwm_name": "m1", "sets_mark": True}, 0)
    assert ledger.commit({"run_id": "old", "job_type": jobs.INCREMENTAL, "status": "success", "hwm_name": "other", "sets_mark": True}, 0) == n


def test_only_one_puts_a_file(spark):
    from concurrent.futures import ThreadPoolExecutor

    from clickweir.fs import put_if_absent, read_text

    path = f"{work_path(spark, 'test-put')}/entry.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: put_if_absent(spark, path, f"writer {i}"), range(8)))
    assert sum(won) == 1 and read_text(spark, path) == f"writer {won.index(True)}"


def test_a_store_without_atomic_create_is_refused(spark, monkeypatch):
    from unittest.mock import MagicMock

    from clickweir import fs as files

    store = MagicMock()
    store.getScheme.return_value = store.getUri().getScheme.return_value = "s3a"
    monkeypatch.setattr(files, "_fs_path", lambda spark, path: (store, MagicMock()))
    with pytest.raises(files.UnsafeStore, match="s3a"):
        files.put_if_absent(spark, "s3a://bucket/entry.json", "x")
    assert not store.create.called


def test_failed_run_leaves_no_scratch_and_its_whole_error(spark, monkeypatch):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    made = []
    real = jobs.work_path
    monkeypatch.setattr(jobs, "work_path", lambda *a: made.append(real(*a)) or made[-1])

    def boom(*a, **k):
        raise RuntimeError("x" * 5000)

    monkeypatch.setattr(jobs, "write_clean_table", boom)
    with pytest.raises(RuntimeError):
        run_full(spark, src, target, stage=True)
    assert len(made) == 2 and not any(path_exists(spark, p) for p in made)
    assert "x" * 5000 in target.ledger(spark).runs().first()["error"]


def test_counts_do_not_depend_on_the_layout(spark):
    src = clickstream_source(spark, SF_SMALL).repartition(4)
    results = [run_full(spark, src, new_target(spark), Caps(1, 4), time_ordered=t, stage=s) for t in (False, True) for s in (False, True)]
    assert {(r["rows_read"], r["rows_written"]) for r in results} == {(1000, 806)}


def test_merge_keeps_rows_and_marks(spark):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    run_incremental(spark, src.filter(F.col("event_time") <= ntz(SPLIT)), target)
    run_incremental(spark, src, target)
    key = lambda r: (r["event_time"], r["product_id"], r["user_id"])
    before = sorted(read_table(spark, target).collect(), key=key)
    mark = target.ledger(spark).state(jobs.HWM_NAME)[1]
    assert jobs.merge_loads(spark, target)["rows_written"] == 978
    assert len(target.ledger(spark).committed_loads()) == 1
    assert len(jobs.vacuum(spark, target)) == 2
    assert sorted(read_table(spark, target).collect(), key=key) == before
    assert target.ledger(spark).state(jobs.HWM_NAME)[1] == mark
    assert run_incremental(spark, src, target)["rows_read"] == 0


class Database:
    """An injected sink: rows per load, as a table with a load column would
    hold them. ``fail`` makes a write stop after it has sent its rows."""

    def __init__(self, spark):
        self.spark, self.rows, self.calls, self.fail = spark, {}, [], False

    def write(self, df, options, mode, truncate, max_connections):
        (load,) = {r["load_id"] for r in df.select("load_id").distinct().collect()}
        if truncate:
            self.rows = {}
        self.rows[load] = self.rows.get(load, 0) + df.count()
        self.calls.append((mode, truncate, max_connections, self.target.ledger(self.spark).committed_loads()[-1] == load))
        if self.fail:
            raise RuntimeError("connection lost")

    def delete(self, spark, options, column, load):
        assert column == "load_id"
        self.rows.pop(load, None)

    def make(self):
        self.target = Target(work_path(self.spark, "test-jdbc-target"), jdbc={"url": "jdbc:x", "dbtable": "t"}, jdbc_connections=4,
                             jdbc_writer=self.write, jdbc_deleter=self.delete)
        return self.target


def test_database_gets_each_load_after_its_commit(spark):
    """The sink is injected: no database is reached."""
    src, db = clickstream_source(spark, SF_SMALL), Database(spark)
    target = db.make()
    run_full(spark, src, target, set_hwm=True)
    run_incremental(spark, src.unionByName(manual_row(spark, dt.datetime(2030, 1, 1))), target)
    run_incremental(spark, src, target)  # nothing new: nothing sent
    assert db.calls == [("overwrite", True, 4, True), ("append", False, 4, True)]
    assert sorted(db.rows.values()) == [1, 978]
    assert jobs.deliver(spark, target) == []


@pytest.mark.parametrize("full", [True, False])
def test_a_crash_while_sending_repeats_nothing(spark, full):
    src, db = clickstream_source(spark, SF_SMALL), Database(spark)
    target = db.make()
    db.fail = True
    with pytest.raises(RuntimeError):
        (run_full if full else run_incremental)(spark, src, target)
    # the load is committed, and sent but not known to be
    assert read_table(spark, target).count() == 978 and list(db.rows.values()) == [978]
    assert len(target.ledger(spark).current().undelivered) == 1
    assert jobs.vacuum(spark, target) == []
    db.fail = False
    run_incremental(spark, manual_row(spark, dt.datetime(2030, 1, 1)), target, hwm_name="other")  # sends both
    assert sorted(db.rows.values()) == [1, 978]
    assert target.ledger(spark).current().undelivered == []


def test_a_merged_load_waits_for_the_database(spark):
    src, db = clickstream_source(spark, SF_SMALL), Database(spark)
    target = db.make()
    db.fail = True
    with pytest.raises(RuntimeError):
        run_incremental(spark, src, target)
    jobs.merge_loads(spark, target)
    assert jobs.vacuum(spark, target) == []
    db.fail = False
    assert len(jobs.deliver(spark, target)) == 1
    assert list(db.rows.values()) == [978] and len(jobs.vacuum(spark, target)) == 1


def late_scenario(spark, lateness, scope=jobs.BATCH_SCOPE, caps=jobs.DEFAULT_CAPS):
    source = lambda hours: jobs._union([manual_row(spark, dt.datetime(2030, 1, 1, h)) for h in hours])
    target = new_target(spark)
    run_incremental(spark, source([1, 5, 5, 8]), target, caps, lateness=lateness, scope=scope)
    run_incremental(spark, source([1, 5, 5, 5, 8, 8, 4, 2, 9]), target, caps, lateness=lateness, scope=scope)
    run_incremental(spark, source([1, 5, 5, 5, 8, 8, 4, 2, 9]), target, caps, lateness=lateness, scope=scope)
    run_incremental(spark, source([1, 5, 5, 5, 8, 8, 4, 2, 9, 7, 4]), target, caps, lateness=lateness, scope=scope)
    return sorted(r["event_time"].hour for r in read_table(spark, target).collect()), target


def test_late_rows_arrive_once_and_repeats_stay(spark):
    hours, target = late_scenario(spark, dt.timedelta(hours=4))
    # 2 is more than four hours under the mark of 8; so is the second 4 under 9
    assert hours == [1, 5, 5, 5, 7, 8, 8, 9]
    assert target.ledger(spark).state(jobs.HWM_NAME)[1] == dt.datetime(2030, 1, 1, 9)
    assert late_scenario(spark, dt.timedelta(hours=7))[0] == [1, 2, 4, 4, 5, 5, 5, 7, 8, 8, 9]
    assert late_scenario(spark, None)[0] == [1, 5, 5, 8, 9]
    assert late_scenario(spark, dt.timedelta(0))[0] == [1, 5, 5, 8, 9]


def test_lateness_starts_anew_after_a_run_without_it(spark):
    target = new_target(spark)
    at = lambda *hours: jobs._union([manual_row(spark, dt.datetime(2030, 1, 1, h)) for h in hours])
    week = dt.timedelta(days=7)
    run_incremental(spark, at(1, 2), target, lateness=week)
    run_incremental(spark, at(1, 2, 4), target)
    run_incremental(spark, at(1, 2, 3, 4, 6), target, lateness=week)  # nothing is known of the time up to 4
    run_incremental(spark, at(1, 2, 3, 4, 5, 6), target, lateness=week)
    assert sorted(r["event_time"].hour for r in read_table(spark, target).collect()) == [1, 2, 4, 5, 6]


def test_caps_over_all_batches(spark, monkeypatch):
    monkeypatch.setattr(jobs, "COUNT_PARTS", 2)
    target = new_target(spark)
    at = lambda *hours: jobs._union([manual_row(spark, dt.datetime(2030, 1, 1, h)) for h in hours])
    caps, kept = Caps(per_user_minute=1, per_session=3), []
    for k in range(1, 7):
        run_incremental(spark, at(*range(1, k + 1)), target, caps, scope=jobs.HISTORY_SCOPE)
        kept.append(read_table(spark, target).count())
    assert kept == [1, 2, 3, 3, 3, 3]  # one session: the fourth row is over the cap
    parts = [v for k, v in target.ledger(spark).current().kept.items() if k.startswith("counts-")]
    assert len(parts) <= 3
    with pytest.raises(ValueError, match="scope"):
        run_incremental(spark, at(1), target, caps, scope="all")


def test_zoned_source_in_another_session_zone_is_refused(spark):
    src = clickstream_source(spark, SF_SMALL)
    zoned = src.withColumn("event_time", F.col("event_time").cast("timestamp"))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for job in (run_full, run_incremental, preview_increment):
            with pytest.raises(ValueError, match="UTC"):
                job(spark, zoned, new_target(spark))
        assert run_full(spark, src, new_target(spark))["rows_written"] == 978  # no zone, no matter
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_refresh_marts_full_then_touched_dates(spark):
    from clickweir.operators import product_metrics
    from clickweir.plans.marts_job import load_dates, refresh_marts

    types = ("view", "click", "purchase")
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    marts = work_path(spark, "test-marts")
    run_full(spark, src, target, set_hwm=True)
    refresh_marts(spark, target, marts, event_types=types, stages=types)
    key = lambda r: (str(r["event_date"]), r["product_id"])
    direct = sorted(product_metrics(read_table(spark, target), types).collect(), key=key)
    stored = spark.read.parquet(f"{marts}/product_metrics")
    assert sorted(stored.select(*direct[0].asDict().keys()).collect(), key=key) == direct
    # an increment adds one row on a new date; only that date is recomputed
    grown = src.unionByName(manual_row(spark, dt.datetime(2030, 1, 1, 8)))
    run_incremental(spark, grown, target)
    load = target.ledger(spark).runs().orderBy(F.desc("seq")).first()["load"]
    dates = load_dates(spark, target, load)
    assert dates == [dt.date(2030, 1, 1)]
    refresh_marts(spark, target, marts, dates=dates, event_types=types, stages=types)
    stored = spark.read.parquet(f"{marts}/product_metrics")
    assert stored.count() == len(direct) + 1
    new = stored.filter("event_date = '2030-01-01'").first()
    assert (new["product_id"], new["view_events"], new["events"]) == (888888888, 1, 1)
    funnel = spark.read.parquet(f"{marts}/funnel_metrics")
    assert funnel.count() == 31


def test_preview_of_nothing_keeps_the_schema(spark):
    src = clickstream_source(spark, SF_SMALL)
    target = new_target(spark)
    run_incremental(spark, src, target)
    p = preview_increment(spark, src, target)
    assert (p.rows_read, p.max_event_time) == (0, None)
    assert p.first_rows.columns == list(jobs.PREVIEW_COLUMNS) and p.first_rows.count() == 0


def test_full_refresh_with_rebalance_same_rows_fewer_files(spark):
    src = clickstream_source(spark, SF_SMALL).repartition(4)  # not in time order
    plain, balanced = new_target(spark), new_target(spark)
    run_full(spark, src, plain, time_ordered=True)
    run_full(spark, src, balanced)
    key = lambda r: (r["event_time"], r["product_id"], r["user_id"])
    a = sorted(read_table(spark, plain).collect(), key=key)
    b = sorted(read_table(spark, balanced).collect(), key=key)
    assert a == b and len(a) == 978

    def files(t):
        return read_table(spark, t).select(F.input_file_name()).distinct().count()

    assert files(balanced) == 30 < files(plain)


def mart_rows(spark, root, name):
    rows = spark.read.parquet(f"{root}/{name}")
    return sorted(map(str, rows.select(*sorted(rows.columns)).collect()))


def assert_marts_like_rebuild(spark, target, kept, types):
    from clickweir.plans.marts_job import MARTS, refresh_marts

    whole = work_path(spark, "test-marts-whole")
    refresh_marts(spark, target, whole, event_types=types, stages=types)
    for name in MARTS:
        assert mart_rows(spark, kept, name) == mart_rows(spark, whole, name)


def test_marts_kept_up_by_loads_equal_a_rebuild(spark, monkeypatch):
    from clickweir.plans import marts_job
    from clickweir.plans.marts_job import update_marts

    monkeypatch.setattr(marts_job, "PARTS", 2)  # every second load merges parts
    types = ("view", "click", "purchase")
    src = clickstream_source(spark, SF_SMALL)
    target, marts = new_target(spark), work_path(spark, "test-marts-kept")
    read = []
    monkeypatch.setattr(marts_job, "read_loads", lambda s, t, loads: read.append(loads) or jobs.read_loads(s, t, loads))
    ends = [SPLIT, SPLIT + dt.timedelta(hours=9), SPLIT + dt.timedelta(days=3)]
    for end in ends:
        run_incremental(spark, src.filter(F.col("event_time") <= ntz(end)), target)
        done = update_marts(spark, target, marts, types, types)
        assert len(done["loads"]) == 1
    # the second load fell on one date, which the first one had rows of, too
    assert done["dates"] == [SPLIT.date() + dt.timedelta(days=i) for i in range(4)]
    assert_marts_like_rebuild(spark, target, marts, types)
    assert update_marts(spark, target, marts, types, types) == {"loads": [], "dates": []}
    # two loads at once, one of them of a new date; a merge and a vacuum of what is known change nothing
    run_incremental(spark, src, target)
    run_incremental(spark, src.unionByName(manual_row(spark, dt.datetime(2030, 1, 1, 8))), target)
    assert len(update_marts(spark, target, marts, types, types)["loads"]) == 2
    jobs.merge_loads(spark, target)
    jobs.vacuum(spark, target)
    assert update_marts(spark, target, marts, types, types) == {"loads": [], "dates": []}
    assert_marts_like_rebuild(spark, target, marts, types)
    assert [x for loads in read for x in loads] == marts_job.original_loads(target.ledger(spark))  # each load once
    # other stages: rolled up again, no load read
    n = len(read)
    done = update_marts(spark, target, marts, types, types[:2])
    assert done == {"loads": [], "dates": None} and len(read) == n
    assert spark.read.parquet(f"{marts}/funnel_metrics").columns.count("stage_3_users") == 0
    # few parts, one state and the one before it
    assert len(jobs.list_dirs(spark, f"{marts}/_partials")) <= 3
    assert len(marts_job.list_files(spark, f"{marts}/_state")) == 2


def test_marts_after_a_full_refresh_and_unseen_merged_loads(spark):
    from clickweir.plans.marts_job import update_marts

    types = ("view", "click", "purchase")
    src = clickstream_source(spark, SF_SMALL)
    target, marts = new_target(spark), work_path(spark, "test-marts-kept")
    assert update_marts(spark, target, marts, types, types) == {"loads": [], "dates": None}  # no load yet: empty tables
    run_full(spark, src, target, set_hwm=True)
    update_marts(spark, target, marts, types, types)
    run_full(spark, src.filter(F.col("event_time") <= ntz(SPLIT)), target, set_hwm=True)
    assert update_marts(spark, target, marts, types, types)["dates"] is None  # dates are gone
    assert_marts_like_rebuild(spark, target, marts, types)
    # an increment that is merged and vacuumed before the tables have seen it
    run_incremental(spark, src, target)
    jobs.merge_loads(spark, target)
    jobs.vacuum(spark, target)
    done = update_marts(spark, target, marts, types, types)
    assert done["loads"] == target.ledger(spark).committed_loads() and done["dates"] is None
    assert_marts_like_rebuild(spark, target, marts, types)


def test_marts_update_that_crashes_is_done_over(spark, monkeypatch):
    from clickweir.plans import marts_job
    from clickweir.plans.marts_job import update_marts

    types = ("view", "click", "purchase")
    src = clickstream_source(spark, SF_SMALL)
    target, marts = new_target(spark), work_path(spark, "test-marts-kept")
    run_incremental(spark, src.filter(F.col("event_time") <= ntz(SPLIT)), target)
    update_marts(spark, target, marts, types, types)
    run_incremental(spark, src, target)
    with monkeypatch.context() as m:
        m.setattr(marts_job, "put_if_absent", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            update_marts(spark, target, marts, types, types)
    assert len(jobs.list_dirs(spark, f"{marts}/_partials")) == 2  # one of them is of no use
    with monkeypatch.context() as m:
        m.setattr(marts_job, "put_if_absent", lambda *a: False)
        with pytest.raises(ConflictingRun):
            update_marts(spark, target, marts, types, types)
    assert len(update_marts(spark, target, marts, types, types)["loads"]) == 1
    assert_marts_like_rebuild(spark, target, marts, types)
    assert len(jobs.list_dirs(spark, f"{marts}/_partials")) == 2
