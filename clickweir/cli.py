"""Command line for spark-submit: ``python -m clickweir <command> ...``.

Each command prints one JSON object (the run's result record, or rows of
the ledger), so a scheduler can run the jobs and read their outcome.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clickweir.operators.traffic_cap import DEFAULT_CAPS, Caps
from clickweir.plans import jobs
from clickweir.plans.ledger import HISTORY_DEFAULT
from clickweir.plans.marts_job import MARTS, load_dates, refresh_marts, update_marts
from clickweir.sources.csv_ingest import ingest_csv
from clickweir.sources.jdbc import jdbc_options, read_jdbc_parallel, read_jdbc_source
from clickweir.sources.parquet import read_events


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clickweir")
    sub = p.add_subparsers(dest="command", required=True)

    def job(name: str, help_: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=help_)
        src = c.add_mutually_exclusive_group(required=True)
        src.add_argument("--source", help="Parquet source table")
        src.add_argument("--jdbc-url", help="JDBC URL of the source database")
        c.add_argument("--jdbc-table", default="raw.events")
        c.add_argument("--jdbc-user")
        c.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
        c.add_argument("--jdbc-driver")
        c.add_argument("--partition-column", default="event_time",
                       help="read in parallel range queries over this column ('': one query)")
        c.add_argument("--partitions", type=int, default=8)
        c.add_argument("--stage", action="store_true", help="copy the batch once, then work on the copy")
        c.add_argument("--target", required=True, help="target root folder")
        c.add_argument("--max-per-minute", type=int, default=DEFAULT_CAPS.per_user_minute)
        c.add_argument("--max-per-session", type=int, default=DEFAULT_CAPS.per_session)
        return c

    def sink(c: argparse.ArgumentParser) -> None:
        c.add_argument("--time-ordered", action="store_true", help="the source stands in time order: write without a shuffle by date")
        c.add_argument("--target-jdbc-url", help="also load the rows into a table of this database")
        c.add_argument("--target-jdbc-table", default="events_clean")
        c.add_argument("--target-jdbc-user")
        c.add_argument("--target-jdbc-password-env")
        c.add_argument("--target-jdbc-driver")
        c.add_argument("--target-jdbc-connections", type=int, default=16)

    full = job("full", "full refresh")
    full.add_argument("--set-hwm", action="store_true")
    full.add_argument("--vacuum", action="store_true")
    full.add_argument("--time-ranges", action="store_true", help="write files that do not overlap in time; reads the source twice")
    sink(full)
    inc = job("incremental", "load rows after the mark")
    inc.add_argument("--lateness-hours", type=float, help="also load rows that arrive late, less than this under the mark")
    inc.add_argument("--history-caps", action="store_true", help="the caps count the rows of all batches so far")
    sink(inc)
    job("preview", "counts and first rows of the next increment; writes nothing")
    # merge: the loads into one; vacuum: superseded folders and ledger files
    for name in ("reset", "merge", "vacuum"):
        sub.add_parser(name).add_argument("--target", required=True)
    d = sub.add_parser("deliver", help="send the loads the database has not got yet")
    d.add_argument("--target", required=True)
    sink(d)
    h = sub.add_parser("history")
    h.add_argument("--target", required=True)
    h.add_argument("--limit", type=int, default=HISTORY_DEFAULT)
    s = sub.add_parser("status")
    s.add_argument("--target", required=True)
    s.add_argument("--run-id", required=True)
    m = sub.add_parser("marts", help="build the summary tables from the published clean table")
    m.add_argument("--target", required=True)
    m.add_argument("--out", required=True, help="root folder of the summary tables")
    which = m.add_mutually_exclusive_group()
    which.add_argument("--last-load", action="store_true", help="only the dates the latest load wrote")
    which.add_argument("--update", action="store_true", help="read only loads the tables do not hold yet, and keep their partial sums")
    i = sub.add_parser("ingest", help="raw CSV -> Parquet source table")
    i.add_argument("--csv", required=True)
    i.add_argument("--table", required=True)
    i.add_argument("--append", action="store_true")
    i.add_argument("--limit", type=int, help="only the first rows in column order (default: all)")
    i.add_argument("--single-line", action="store_true", help="no field holds a line break: read files in parallel splits")
    return p


def _secret(name: str | None) -> str | None:
    return os.environ.get(name, "") if name else None


def _target(args) -> jobs.Target:
    if not args.target_jdbc_url:
        return jobs.Target(args.target)
    opts = jdbc_options(args.target_jdbc_url, args.target_jdbc_table, user=args.target_jdbc_user,
                        password=_secret(args.target_jdbc_password_env), driver=args.target_jdbc_driver)
    return jobs.Target(args.target, jdbc=opts, jdbc_connections=args.target_jdbc_connections)


def _source(spark: SparkSession, args):
    if args.source:
        return read_events(spark, args.source)
    opts = jdbc_options(args.jdbc_url, args.jdbc_table, user=args.jdbc_user, password=_secret(args.jdbc_password_env), driver=args.jdbc_driver)
    if args.partition_column:
        return read_jdbc_parallel(spark, opts, args.partition_column, args.partitions)
    return read_jdbc_source(spark, opts)


def _rows(df) -> list[dict]:
    return [{k: (v.isoformat() if hasattr(v, "isoformat") else v) for k, v in r.asDict().items()} for r in df.collect()]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    # dates, hours and marks are those of UTC
    spark = spark or SparkSession.builder.appName(f"clickweir-{args.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    c = args.command
    if c in ("full", "incremental", "preview"):
        caps = Caps(args.max_per_minute, args.max_per_session)
        src = _source(spark, args)
        if c == "full":
            out = jobs.run_full(spark, src, _target(args), caps, set_hwm=args.set_hwm, time_ordered=args.time_ordered,
                                stage=args.stage, vacuum_after=args.vacuum, time_ranges=args.time_ranges)
        elif c == "incremental":
            late = None if args.lateness_hours is None else dt.timedelta(hours=args.lateness_hours)
            out = jobs.run_incremental(spark, src, _target(args), caps, time_ordered=args.time_ordered, stage=args.stage, lateness=late,
                                       scope=jobs.HISTORY_SCOPE if args.history_caps else jobs.BATCH_SCOPE)
        else:
            p = jobs.preview_increment(spark, src, args.target, caps)
            out = {"rows_read": p.rows_read, "rows_after_filtering": p.rows_after_filtering,
                   "max_event_time": p.max_event_time.isoformat() if p.max_event_time else None,
                   "first_rows": _rows(p.first_rows)}
    elif c == "reset":
        jobs.reset_mark(spark, args.target)
        out = {"reset": True}
    elif c == "merge":
        out = jobs.merge_loads(spark, args.target)
    elif c == "deliver":
        out = {"delivered": jobs.deliver(spark, _target(args))}
    elif c == "vacuum":
        out = {"deleted": jobs.vacuum(spark, args.target)}
    elif c == "marts" and args.update:
        done = update_marts(spark, args.target, args.out)
        out = {"tables": list(MARTS), "loads": done["loads"], "dates": None if done["dates"] is None else [d.isoformat() for d in done["dates"]]}
    elif c == "marts":
        dates = None
        if args.last_load:
            runs = jobs.Target(args.target).ledger(spark).runs().filter("status = 'success' AND load IS NOT NULL")
            last = runs.orderBy(F.desc("seq")).first()
            dates = load_dates(spark, args.target, last["load"]) if last else []
        refresh_marts(spark, args.target, args.out, dates)
        out = {"tables": list(MARTS), "dates": None if dates is None else [d.isoformat() for d in dates]}
    elif c == "history":
        out = {"items": _rows(jobs.Target(args.target).ledger(spark).history(args.limit))}
    elif c == "status":
        out = _rows(jobs.Target(args.target).ledger(spark).status(args.run_id))[0]
    else:
        got = ingest_csv(spark, args.csv, args.table, append=args.append, limit=args.limit, multi_line=not args.single_line)
        out = {"rows_loaded": got.rows, "malformed_rows": got.malformed}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
