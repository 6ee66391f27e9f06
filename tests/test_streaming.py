import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from clickweir.plans.jobs import Target, read_table, run_batch
from clickweir.schema import SOURCE_SCHEMA
from clickweir.session import work_path
from clickweir.sources import clickstream_source
from clickweir.streaming import start_stream
from conftest import SF_SMALL


def test_stream_loads_new_files_once(spark):
    src = clickstream_source(spark, SF_SMALL)
    landing = work_path(spark, "test-landing")
    split = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    target = Target(work_path(spark, "test-stream"))
    for rows in (src.filter(F.col("event_time") <= split), src.filter(F.col("event_time") > split)):
        rows.repartition(3).write.mode("append").parquet(landing)  # several files per arrival
        start_stream(spark, landing, target).awaitTermination()
    runs = target.ledger(spark).runs().orderBy("seq").collect()
    assert [r["rows_read"] for r in runs] == [503, 486]
    assert read_table(spark, target).count() == 978
    # restart on the same checkpoint: nothing new, nothing reloaded
    start_stream(spark, landing, target).awaitTermination()
    assert target.ledger(spark).runs().count() == 2
    # a new file with a row older than all before: it is loaded like any other
    late = dt.datetime(2024, 1, 2)
    new = dt.datetime(2031, 1, 1)
    rows = [
        (t, "view", 888888888, 1, "manual.test.category", "manual_brand", Decimal("99.99"), 123456789, "s")
        for t in (late, new)
    ]
    spark.createDataFrame(rows, SOURCE_SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    start_stream(spark, landing, target).awaitTermination()
    last = target.ledger(spark).runs().orderBy(F.desc("seq")).first()
    assert (last["rows_read"], last["rows_written"]) == (2, 2)
    assert read_table(spark, target).count() == 980


def test_files_out_of_order_one_a_batch(spark):
    src = clickstream_source(spark, SF_SMALL)
    landing = work_path(spark, "test-landing-late")
    split = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    target = Target(work_path(spark, "test-stream-late"))
    for rows in (src.filter(F.col("event_time") > split), src.filter(F.col("event_time") <= split)):
        rows.coalesce(1).write.mode("append").parquet(landing)
    start_stream(spark, landing, target, max_files_per_trigger=1).awaitTermination()
    assert target.ledger(spark).runs().count() == 2
    assert read_table(spark, target).count() == 978


def test_replayed_batch_is_skipped(spark):
    rows = clickstream_source(spark, SF_SMALL)
    target = Target(work_path(spark, "test-batch"))
    assert run_batch(spark, rows, target, "stream:0")["rows_written"] == 978
    assert run_batch(spark, rows, target, "stream:0") is None
    assert read_table(spark, target).count() == 978


def test_polling_stream_drains_and_stops(spark):
    src = clickstream_source(spark, SF_SMALL)
    landing = work_path(spark, "test-landing-poll")
    src.write.parquet(landing)
    target = Target(work_path(spark, "test-stream-poll"))
    q = start_stream(spark, landing, target, processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_table(spark, target).count() == 978
    assert target.ledger(spark).runs().count() == 1
