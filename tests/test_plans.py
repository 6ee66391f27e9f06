"""Physical-plan checks: one scan, pushed filters, no Python in the hot path,
no shuffle of whole rows when the violator set is broadcast."""

import datetime as dt
import glob
import itertools

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clickweir.operators import Caps, clean_events, find_violators, drop_violators, require_columns
from clickweir.plans.jobs import increment_bounds
from clickweir.queries import registry
from clickweir.session import work_path
from clickweir.sources import clickstream_source, read_clean_table, read_events, write_clean_table
from conftest import SF_SMALL


def plan_text(df):
    """Executed plan; for an adaptive plan only its final section."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def source_table(spark):
    path = work_path(spark, "plan-source")
    clickstream_source(spark, SF_SMALL).write.parquet(path)
    return path


def executed_plans(spark):
    """Plans of all SQL executions so far, those inside jobs and streams among them."""
    store = spark._jsparkSession.sharedState().statusStore()
    runs = store.executionsList()
    return [runs.apply(i).physicalPlanDescription() for i in range(runs.size())], store


@pytest.mark.parametrize("key", sorted(registry()))
def test_no_python_udfs(spark, key):
    before = len(executed_plans(spark)[0])
    df = registry()[key](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    plans = executed_plans(spark)[0][min(before, 900):]
    assert plans
    for text in [*plans, plan_text(df)]:
        assert "EvalPython" not in text and "InPandas" not in text and "InArrow" not in text


def test_the_parts_are_not_collected_for_a_broadcast(spark):
    """Their files look small, so their size on disk does not keep them from the driver."""
    view = clickstream_source(spark, SF_SMALL)
    view.collect()
    text = view._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in text and "SortMergeJoin" in text


def test_required_filters_reach_the_scan(spark, source_table):
    df = require_columns(read_events(spark, source_table))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_time), IsNotNull(product_id)]" in text


def test_increment_bounds_are_pushed(spark, source_table):
    src = read_events(spark, source_table)
    batch, high = increment_bounds(src, dt.datetime(2024, 1, 15, 12))
    text = plan_text(batch)
    assert "GreaterThan(event_time,2024-01-15T12:00)" in text
    assert "LessThanOrEqual(event_time," in text


def test_violator_plan_broadcasts_and_does_not_shuffle_rows(spark, source_table):
    src = require_columns(read_events(spark, source_table))
    v = find_violators(src, Caps(1, 4))
    assert v.minute_keys > 0 and v.session_keys > 0
    out = drop_violators(src, v)
    out.collect()
    text = plan_text(out)
    assert text.count("BroadcastHashJoin") == 2 and "LeftAnti" in text
    assert "Exchange hashpartitioning" not in text


def test_violator_plan_without_broadcast_falls_back_to_shuffle_join(spark, source_table):
    src = require_columns(read_events(spark, source_table))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        out = drop_violators(src, find_violators(src, Caps(1, 4)), broadcast_bytes=0)
        out.collect()
        text = plan_text(out)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in text or "ShuffledHashJoin" in text
    sure, maybe = union_branches(text)
    # rows the Bloom filter excludes meet no exchange; only possible matches are shuffled
    assert "Scan parquet" in sure and "BroadcastHashJoin" in sure and "Exchange" not in sure and "ShuffleQueryStage" not in sure
    assert "SortMergeJoin" in maybe and "Exchange hashpartitioning" in maybe


def union_branches(text):
    """The branches of the plan's union, without what is broadcast."""
    lines = text.splitlines()
    at = next(i for i, x in enumerate(lines) if x.lstrip(" :+-").startswith("Union"))
    depth, branches, skip = None, [], None
    for x in lines[at + 1 :]:
        level = len(x) - len(x.lstrip(" :+-"))
        depth = level if depth is None else depth
        if level < depth:
            break
        if level == depth:
            branches.append([])
            skip = None
        if skip is not None and level > skip:
            continue
        skip = level if "BroadcastQueryStage" in x or "BroadcastExchange" in x else None
        if skip is None:
            branches[-1].append(x)
    return ["\n".join(b) for b in branches]


def test_no_violators_means_no_join(spark, source_table):
    src = require_columns(read_events(spark, source_table))
    out = drop_violators(src, find_violators(src, Caps(1000, 100000)))
    text = plan_text(out)
    assert "Join" not in text


def test_violator_aggregate_is_partial_and_uses_one_scan(spark, source_table):
    from clickweir.operators import violator_keys

    text = plan_text(violator_keys(require_columns(read_events(spark, source_table)), Caps(1, 4)))
    assert text.count("FileScan parquet") == 1
    assert "Expand" in text and "partial_count" in text


def _files_and_dates(spark, path):
    files = spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().count()
    dates = spark.read.parquet(path).select("event_date").distinct().count()
    return files, dates


@pytest.mark.parametrize("join", ["broadcast", "shuffle"])
def test_clean_table_write_layout(spark, source_table, join):
    # an unordered source: every task holds every date
    shuffled = read_events(spark, source_table).repartition(4)
    rows = require_columns(shuffled)
    v = find_violators(rows, Caps(1, 4))
    cleaned = clean_events(shuffled, violators=v, broadcast_bytes=0 if join == "shuffle" else 1 << 26)
    path = work_path(spark, "plan-write")
    write_clean_table(cleaned, path)
    files, dates = _files_and_dates(spark, path)
    assert files == dates  # REBALANCE: one file per date at this size
    # each file is sorted by the target's storage order
    got = spark.read.parquet(path).select("event_date", "event_time", "product_id", F.input_file_name().alias("f")).collect()
    per_file = {}
    for r in got:
        per_file.setdefault(r["f"], []).append((r["event_time"], r["product_id"]))
    assert all(v == sorted(v) for v in per_file.values())


def test_time_ordered_source_writes_without_shuffle(spark, source_table):
    path = work_path(spark, "plan-write-ordered")
    df = clean_events(read_events(spark, source_table))
    write_clean_table(df, path, time_ordered=True)
    files, dates = _files_and_dates(spark, path)
    assert files == dates  # one scan task over a time-ordered file: one file per date


def time_spans(path):
    """{date folder: (least, greatest event time) of its files by their footers, in order}."""
    spans = {}
    for file in glob.glob(f"{path}/event_date=*/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("event_time")
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        spans.setdefault(file.split("/")[-2], []).append((min(s.min for s in stats), max(s.max for s in stats)))
    return {date: sorted(v) for date, v in spans.items()}


def one_hot_date(rows):
    """Two thirds of the rows on one date, 40 times of it, many at the first."""
    minute = F.when(F.col("user_id") % 4 == 0, 0).otherwise(F.pmod(F.xxhash64("product_id", "user_id", "event_time"), F.lit(40)))
    time = F.when(F.col("user_id") % 3 != 0, F.make_timestamp_ntz(F.lit(2030), F.lit(1), F.lit(1), F.lit(5), minute.cast("int"), F.lit(0))).otherwise(F.col("event_time"))
    return rows.withColumn("event_time", time).withColumn("event_date", F.to_date("event_time"))


def test_files_of_a_hot_date_do_not_overlap_in_time(spark, source_table):
    rows = one_hot_date(clean_events(read_events(spark, source_table).repartition(4)))
    path = work_path(spark, "plan-write-ranges")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clean_table(rows, path, time_ranges=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = time_spans(path)
    assert len(spans["event_date=2030-01-01"]) >= 4
    assert all(a[1] <= b[0] for v in spans.values() for a, b in itertools.pairwise(v))
    back = read_clean_table(spark, path)
    assert back.exceptAll(rows.select(*back.columns)).count() == 0 and back.count() == rows.count()
    with pytest.raises(ValueError, match="ranges"):
        write_clean_table(rows, path, time_ordered=True, time_ranges=True)


def test_shuffle_fallback_splits_the_hot_null_session(spark):
    """A third of the rows share the null session; without broadcast the
    anti-join is a sort-merge join and AQE splits that hot partition."""
    import datetime as dt

    from clickweir.schema import SOURCE_SCHEMA

    t0 = dt.datetime(2024, 1, 1)
    data = [
        (t0 + dt.timedelta(seconds=i), "view", i, 1, "a", "b", None, i % 7000, None if i % 3 == 0 else f"s{i % 5000}")
        for i in range(30000)
    ]
    df = spark.createDataFrame(data, SOURCE_SCHEMA).repartition(8)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        v = find_violators(df, Caps(30, 4))
        assert (v.minute_keys, v.session_keys) == (0, 1)
        out = drop_violators(df, v, broadcast_bytes=0)
        assert out.count() == 20000
        rows = out.collect()
        text = plan_text(out)
    finally:
        for k, val in old.items():
            spark.conf.unset(k) if val is None else spark.conf.set(k, val)
    assert len(rows) == 20000
    assert "SortMergeJoin(skew=true)" in text and "AQEShuffleRead skewed" in text
