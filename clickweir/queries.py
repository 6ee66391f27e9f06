"""Registered queries: one per operator of the inventory, each
``(spark, sf_dir) -> DataFrame`` over the driver's tables.

Queries that exercise a sink or a job write under the shared folder
(``spark.checkpoint.dir``) and return what a reader sees afterwards.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.functions import (
    category_levels,
    clean_category_code,
    day_of_week,
    event_date,
    event_hour,
    minute_bucket,
    parse_event_time,
    parse_long,
    parse_price,
)
from clickweir.operators import (
    Caps,
    batch_max_time,
    category_metrics,
    clean_events,
    contract_check,
    count_per_key,
    funnel_metrics,
    product_metrics,
    require_columns,
    with_minute,
)
from clickweir.plans.jobs import (
    HISTORY_SCOPE,
    Target,
    increment_bounds,
    mark_literal,
    preview_increment,
    read_table,
    run_full,
    run_incremental,
)
from clickweir.plans.marts_job import update_marts
from clickweir.schema import SOURCE_COLUMNS, TARGET_SORT
from clickweir.session import work_path
from clickweir.streaming import start_stream
from clickweir.sources import (
    clickstream_source,
    clickstream_view,
    ingest_csv,
    pruned,
    read_clean_table,
    write_clean_table,
)

# Caps that bite on the test data (the default 30/500 rarely do).
TEST_CAPS = Caps(per_user_minute=1, per_session=4)
# Caps that never bite: what a batch holds then does not change its rows.
UNCAPPED = Caps(per_user_minute=1 << 60, per_session=1 << 60)
# The point in time where the test data is split into two increments.
SPLIT = dt.datetime(2024, 1, 15, 12, 0, 0)
# Points in time where it is split into four loads for the summary tables.
LOAD_ENDS = (dt.datetime(2024, 1, 8, 6), SPLIT, dt.datetime(2024, 1, 15, 18))
# Event vocabulary of the test data, for the summary tables.
TEST_EVENT_TYPES = ("view", "click", "purchase")
TEST_FUNNEL = ("view", "click", "purchase")
INGEST_LIMIT = 2500
SAMPLE_ROWS = 20
HISTORY_ROWS = 3

LEDGER_COLUMNS = (
    "seq",
    "job_type",
    "status",
    "hwm_low",
    "hwm_high",
    "rows_read",
    "rows_before_filtering",
    "rows_after_filtering",
    "rows_written",
)

Query = Callable[[SparkSession, str], DataFrame]


def _view(spark: SparkSession, sf: str) -> DataFrame:
    return clickstream_view(spark, sf)


def _src(spark: SparkSession, sf: str) -> DataFrame:
    return clickstream_source(spark, sf)


_NTZ = T.TimestampNTZType()


def _as_of(src: DataFrame, when: dt.datetime) -> DataFrame:
    """The source as it stood at ``when`` (rows with a later event time not yet arrived)."""
    return src.filter(F.col("event_time") <= mark_literal(when, _NTZ))


# --- scans and filters -----------------------------------------------------


def q_snapshot_scan(spark, sf):
    """Every source row and column."""
    return _view(spark, sf)


def q_pruned_scan(spark, sf):
    """S3: the nine source columns only (the scan reads just those)."""
    return pruned(_view(spark, sf))


def q_filter_required(spark, sf):
    """rows with event_time and product_id."""
    return require_columns(_view(spark, sf))


# --- column functions ------------------------------------------------------


def q_clean_category(spark, sf):
    """P1-P4: 'nan' codes become null, others unchanged."""
    return _view(spark, sf).select("event_id", clean_category_code("category_code").alias("category_code"))


def q_calendar_fields(spark, sf):
    """Date, hour, day of week (1 = Sunday)."""
    return _view(spark, sf).select(
        "event_id",
        event_date("event_time").alias("event_date"),
        event_hour("event_time").alias("event_hour"),
        day_of_week("event_time").alias("day_of_week"),
    )


def q_category_levels(spark, sf):
    """Three levels of the cleaned dotted path."""
    return _view(spark, sf).select("event_id", *category_levels(clean_category_code("category_code")))


def q_minute_bucket(spark, sf):
    """P10: event time truncated to the minute."""
    return _view(spark, sf).select("event_id", minute_bucket("event_time").alias("event_minute"))


# --- window counts and the cap --------------------------------------------


def q_events_per_minute(spark, sf):
    """Rows per (user, minute), on every row."""
    rows = with_minute(require_columns(_view(spark, sf)))
    counted = count_per_key(rows, ["user_id", "event_minute"], "events_per_minute")
    return counted.select("event_id", "user_id", "event_minute", "events_per_minute")


def q_events_per_session(spark, sf):
    """Rows per session (null sessions are one group), on every row."""
    counted = count_per_key(require_columns(_view(spark, sf)), ["user_session"], "events_per_session")
    return counted.select("event_id", "user_session", "events_per_session")


def q_clean_events(spark, sf):
    """J1 flagship: the full transform with the default caps 30/500."""
    return clean_events(_src(spark, sf))


def q_traffic_cap(spark, sf):
    """F3 with caps that bite (1/4)."""
    return clean_events(_src(spark, sf), TEST_CAPS)


# Residues of event_id whose type is null and whose price is
# a decimal too wide for the target.
NULL_TYPE_EVERY = 83
WIDE_PRICE_EVERY = 79


def q_contract_check(spark, sf):
    """Violations of the target's column contract, one row. The source
    here has null event types and prices wider than the target's."""
    view = _view(spark, sf)
    wide = F.col("price").cast("decimal(24,4)")
    planted = view.withColumn("event_type", F.when(F.col("event_id") % NULL_TYPE_EVERY == 0, F.lit(None)).otherwise(F.col("event_type"))).withColumn(
        "price", F.when(F.col("event_id") % WIDE_PRICE_EVERY == 0, wide + F.lit(10**12).cast("decimal(14,0)")).otherwise(wide)
    )
    return contract_check(clean_events(planted))


# --- increments ------------------------------------------------------------


def q_hwm_bounds(spark, sf):
    """Bounds and size of the batch after a mark."""
    batch, high = increment_bounds(_src(spark, sf), SPLIT)
    return batch.agg(
        mark_literal(SPLIT, _NTZ).alias("hwm_low"),
        mark_literal(high, _NTZ).alias("hwm_high"),
        F.count(F.lit(1)).alias("rows"),
    )


def q_incremental_scan(spark, sf):
    """The rows of (mark, max]."""
    batch, _ = increment_bounds(_view(spark, sf), SPLIT)
    return batch


def q_incremental_late(spark, sf):
    """Mark = the time of an existing row: that row is not read again."""
    view = _view(spark, sf)
    mark = view.filter(F.col("event_time") > mark_literal(SPLIT, _NTZ)).agg(F.min("event_time").alias("m")).first()["m"]
    batch, _ = increment_bounds(view, mark)
    return batch


def _two_increments(spark, sf, caps: Caps, full_first: bool = False) -> Target:
    """Arrival scenario: the source as of SPLIT, then all of it, then no news."""
    src = _src(spark, sf)
    target = Target(work_path(spark, "increments"))
    if full_first:
        run_full(spark, src, target, caps)
    run_incremental(spark, _as_of(src, SPLIT), target, caps)
    run_incremental(spark, src, target, caps)
    run_incremental(spark, src, target, caps)
    return target


def q_incremental_run(spark, sf):
    """Ledger rows of three increments as the source grows (caps 1/4)."""
    target = _two_increments(spark, sf, TEST_CAPS)
    return target.ledger(spark).runs().select(*LEDGER_COLUMNS)


# Residue of event_id whose rows arrive late, after the first
# increment, and how far under the mark late rows are still loaded.
LATE_EVERY, LATE_REST = 10, 3
LATENESS = dt.timedelta(days=5)


def q_incremental_lateness(spark, sf):
    """Late rows: some rows up to SPLIT arrive only after the first increment,
    every row twice. Those less than LATENESS under its mark are loaded by the
    second one, once each; the earlier ones never; a third one finds nothing."""
    view = _view(spark, sf)
    view = view.unionByName(view)  # repeats are legal and stay
    late = F.col("event_id") % LATE_EVERY == LATE_REST
    src = view.select(*SOURCE_COLUMNS)
    first = view.filter(~late & (F.col("event_time") <= mark_literal(SPLIT, _NTZ))).select(*SOURCE_COLUMNS)
    target = Target(work_path(spark, "lateness"))
    for rows in (first, src, src):
        run_incremental(spark, rows, target, UNCAPPED, lateness=LATENESS)
    return read_table(spark, target)


def q_traffic_cap_history(spark, sf):
    """F3 over all batches: two increments whose caps count both."""
    src = _src(spark, sf)
    target = Target(work_path(spark, "cap-history"))
    run_incremental(spark, _as_of(src, SPLIT), target, TEST_CAPS, scope=HISTORY_SCOPE)
    run_incremental(spark, src, target, TEST_CAPS, scope=HISTORY_SCOPE)
    return read_table(spark, target)


def q_incremental_empty(spark, sf):
    """A second run over an unchanged source: zero counts, nothing written."""
    src = _src(spark, sf)
    target = Target(work_path(spark, "empty"))
    run_incremental(spark, src, target)
    run_incremental(spark, src, target)
    return target.ledger(spark).runs().select(*LEDGER_COLUMNS, F.col("load").isNotNull().alias("wrote"))


def q_incremental_two_marks(spark, sf):
    """Two marks on one target, each over its own half of the source;
    neither touches the other's loads, and readers see both."""
    src = _src(spark, sf)
    target = Target(work_path(spark, "two-marks"))
    run_incremental(spark, _as_of(src, SPLIT), target, hwm_name="first_half")
    run_incremental(spark, src.filter(F.col("event_time") > mark_literal(SPLIT, _NTZ)), target, hwm_name="second_half")
    return read_table(spark, target)


def _after_first_increment(spark, sf) -> tuple[DataFrame, Target]:
    src = _src(spark, sf)
    target = Target(work_path(spark, "preview"))
    run_incremental(spark, _as_of(src, SPLIT), target)
    return src, target


def q_incremental_preview(spark, sf):
    """First ten rows of the next increment; nothing is written."""
    src, target = _after_first_increment(spark, sf)
    return preview_increment(spark, src, target).first_rows


def q_batch_max_time(spark, sf):
    """Max event time of the next increment after it is cleaned."""
    src, target = _after_first_increment(spark, sf)
    _, mark, _ = target.ledger(spark).state()
    batch, _ = increment_bounds(src, mark)
    return batch_max_time(clean_events(batch))


def q_stream_increments(spark, sf):
    """The source lands in two arrivals (up to SPLIT, then the rest); after
    each, the stream drains the new files as one micro-batch and loads it."""
    src = _src(spark, sf)
    landing = work_path(spark, "landing")
    target = Target(work_path(spark, "stream"))
    arrivals = [_as_of(src, SPLIT), src.filter(F.col("event_time") > mark_literal(SPLIT, _NTZ))]
    for rows in arrivals:
        rows.write.mode("append").parquet(landing)
        start_stream(spark, landing, target, TEST_CAPS).awaitTermination()
    return target.ledger(spark).runs().select(*LEDGER_COLUMNS)


def q_stream_unordered(spark, sf):
    """Later rows land before earlier ones and each arrival is drained on its
    own: every row is loaded (null times are no clean rows)."""
    src = _src(spark, sf)
    landing = work_path(spark, "landing")
    target = Target(work_path(spark, "stream"))
    late = F.coalesce(F.col("event_time") > mark_literal(SPLIT, _NTZ), F.lit(False))
    for rows in (src.filter(late), src.filter(~late)):
        rows.write.mode("append").parquet(landing)
        start_stream(spark, landing, target, UNCAPPED).awaitTermination()
    return read_table(spark, target)


# --- sinks and jobs --------------------------------------------------------


def q_clean_table_write(spark, sf):
    """The clean table written partitioned and sorted, read back."""
    path = work_path(spark, "clean-table")
    write_clean_table(clean_events(_src(spark, sf)), path)
    return read_clean_table(spark, path)


def q_full_refresh(spark, sf):
    """Two full refreshes; readers see only the second snapshot."""
    src = _src(spark, sf)
    target = Target(work_path(spark, "full"))
    run_full(spark, src, target)
    run_full(spark, src, target, TEST_CAPS)
    return read_table(spark, target)


def q_job_metrics(spark, sf):
    """Counts recorded by a full run."""
    target = Target(work_path(spark, "metrics"))
    run_full(spark, _src(spark, sf), target, TEST_CAPS)
    return target.ledger(spark).runs().select(
        "job_type", "status", "rows_read", "rows_before_filtering", "rows_after_filtering", "rows_written"
    )


def q_sample_rows(spark, sf):
    """First rows of the clean table in storage order."""
    order = [F.col(c).asc_nulls_last() for c in (*TARGET_SORT, "user_id", "event_type", "user_session")]
    return clean_events(_src(spark, sf)).orderBy(*order).limit(SAMPLE_ROWS)


def q_run_history(spark, sf):
    """The latest three runs, newest first."""
    target = _two_increments(spark, sf, TEST_CAPS, full_first=True)
    return target.ledger(spark).history(HISTORY_ROWS).select(*LEDGER_COLUMNS)


def q_run_status(spark, sf):
    """One run looked up by id."""
    target = Target(work_path(spark, "status"))
    res = run_full(spark, _src(spark, sf), target, TEST_CAPS)
    return target.ledger(spark).status(res["run_id"]).select(*LEDGER_COLUMNS)


# --- CSV ingest --------------------------------------------------------------

# Residue of event_id whose price is written as the text 'nan'.
NAN_PRICE_EVERY = 13


# Fixed value: residue of event_id whose brand holds quotes, a comma and a line break.
QUOTED_EVERY = 7


def quoted_brand(brand) -> Column:
    return F.concat(brand, F.lit(' "pro", inc\nltd'))


def raw_csv_frame(view: DataFrame) -> DataFrame:
    """The clickstream view rendered as the raw export would hold it: text
    columns, times with a zone suffix, dirty numbers, one extra column."""
    s = lambda c: F.col(c).cast("string")
    return view.select(
        F.when(F.col("event_time").isNull(), F.lit("not a time"))
        .otherwise(F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
        .alias("event_time"),
        "event_type",
        F.when(F.col("product_id").isNull(), F.lit("n/a")).otherwise(s("product_id")).alias("product_id"),
        s("category_id").alias("category_id"),
        "category_code",
        F.when(F.col("event_id") % QUOTED_EVERY == 0, quoted_brand(F.col("brand"))).otherwise(F.col("brand")).alias("brand"),
        F.when(F.col("event_id") % NAN_PRICE_EVERY == 0, F.lit("nan")).otherwise(s("price")).alias("price"),
        s("user_id").alias("user_id"),
        "user_session",
        s("event_id").alias("row_number"),
    )


def write_raw_csv(spark: SparkSession, sf: str) -> str:
    """The export as CSV text of our own making, not by Spark's CSV writer:
    every field in quotes, quotes inside doubled, nulls empty."""
    path = work_path(spark, "raw-csv")
    rows = raw_csv_frame(_view(spark, sf))

    def field(c: str) -> Column:
        return F.coalesce(F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))

    line = F.concat_ws(",", *[field(c) for c in rows.columns])
    # one file a partition, each with the header first
    numbered = rows.select(line.alias("value"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    # every part's first row carries the header line
    first = F.col("at") == F.shiftleft(F.col("part").cast("long"), 33)
    header = ",".join(rows.columns)
    numbered.select(F.when(first, F.concat(F.lit(header + "\n"), F.col("value"))).otherwise(F.col("value")).alias("value")).write.text(path)
    return path


def q_csv_ingest(spark, sf):
    """A raw CSV export loaded with tolerant coercion."""
    csv = write_raw_csv(spark, sf)
    table = work_path(spark, "raw-events")
    ingest_csv(spark, csv, table)
    return spark.read.parquet(table)


def q_ingest_limit(spark, sf):
    """The first rows of the export in a stated order."""
    csv = write_raw_csv(spark, sf)
    table = work_path(spark, "raw-events")
    ingest_csv(spark, csv, table, limit=INGEST_LIMIT)
    return spark.read.parquet(table)


def q_ingest_append(spark, sf):
    """Overwrite twice, then append: two copies."""
    csv = write_raw_csv(spark, sf)
    table = work_path(spark, "raw-events")
    ingest_csv(spark, csv, table)
    ingest_csv(spark, csv, table)  # overwrite: still one copy
    ingest_csv(spark, csv, table, append=True)
    return spark.read.parquet(table)


# Seven renderings of an event time cycle over event_id.
def event_time_texts(view: DataFrame) -> DataFrame:
    t = F.col("event_time")
    slot = F.col("event_id") % 7
    micro = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    text = (
        F.when(t.isNull(), F.lit("garbage"))
        .when(slot == 0, F.concat(F.date_format(t, micro), F.lit(" UTC")))
        .when(slot == 1, F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
        .when(slot == 2, F.concat(F.date_format(t + F.expr("INTERVAL 3 HOURS"), micro), F.lit("+03:00")))
        .when(slot == 3, F.date_format(t, "yyyy-MM-dd"))
        # one hour ahead of UTC all through the data's January
        .when(slot == 4, F.concat(F.date_format(t + F.expr("INTERVAL 1 HOUR"), micro), F.lit(" Europe/Paris")))
        .when(slot == 5, F.concat(F.date_format(t, micro), F.lit(" Mars/Olympus")))
        .otherwise(F.date_format(t, micro))
    )
    return view.select("event_id", text.alias("event_time_text"))


def q_ingest_event_time(spark, sf):
    """Times written in many ways (zones, offsets, names, dates alone, junk) parsed back."""
    texts = event_time_texts(_view(spark, sf))
    return texts.select("event_id", parse_event_time("event_time_text").alias("event_time"))


def numeric_texts(view: DataFrame) -> DataFrame:
    slot = F.col("event_id") % 3
    return view.select(
        "event_id",
        F.when(F.col("product_id").isNull(), F.lit("x1"))
        .when(F.col("event_id") % 5 == 0, F.concat(F.col("product_id").cast("string"), F.lit(".0000001")))
        .when(slot == 0, F.concat(F.col("product_id").cast("string"), F.lit(".0")))
        .otherwise(F.col("product_id").cast("string"))
        .alias("product_text"),
        F.concat(F.lit(" "), F.col("category_id").cast("string"), F.lit(" ")).alias("category_text"),
        F.when(F.col("event_id") % NAN_PRICE_EVERY == 0, F.lit("nan"))
        .when(slot == 1, F.concat(F.col("price").cast("string"), F.lit("5")))
        .otherwise(F.col("price").cast("string"))
        .alias("price_text"),
        F.when(slot == 2, F.lit("12.5")).otherwise(F.col("user_id").cast("string")).alias("user_text"),
    )


def q_ingest_coerce_numeric(spark, sf):
    """Dirty integer and price text coerced; bad values become null."""
    t = numeric_texts(_view(spark, sf))
    return t.select(
        "event_id",
        parse_long("product_text").alias("product_id"),
        parse_long("category_text").alias("category_id"),
        parse_price("price_text").alias("price"),
        parse_long("user_text").alias("user_id"),
    )


# --- summary tables ----------------------------------------------------------


def q_product_metrics(spark, sf):
    """M1 on the clean events."""
    return product_metrics(clean_events(_src(spark, sf)), TEST_EVENT_TYPES)


def q_category_metrics(spark, sf):
    """M2 on the clean events."""
    return category_metrics(clean_events(_src(spark, sf)), TEST_EVENT_TYPES)


def q_funnel_metrics(spark, sf):
    """M3 on the clean events."""
    return funnel_metrics(clean_events(_src(spark, sf)), TEST_FUNNEL)


def _marts_by_loads(spark, sf) -> str:
    """Root of summary tables that were brought up to the clean table after
    each of four loads, two of which share a date, from their partials alone."""
    src = _src(spark, sf)
    target, marts = Target(work_path(spark, "by-loads")), work_path(spark, "marts-by-loads")
    for rows in (*(_as_of(src, end) for end in LOAD_ENDS), src):
        run_incremental(spark, rows, target, UNCAPPED)
        update_marts(spark, target, marts, TEST_EVENT_TYPES, TEST_FUNNEL)
    return marts


def q_product_metrics_by_loads(spark, sf):
    """M1 kept up by loads."""
    return spark.read.parquet(f"{_marts_by_loads(spark, sf)}/product_metrics")


def q_category_metrics_by_loads(spark, sf):
    """M2 kept up by loads."""
    return spark.read.parquet(f"{_marts_by_loads(spark, sf)}/category_metrics")


def q_funnel_metrics_by_loads(spark, sf):
    """M3 kept up by loads."""
    return spark.read.parquet(f"{_marts_by_loads(spark, sf)}/funnel_metrics")


def registry() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}

