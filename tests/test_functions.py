import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

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

CASES = [
    # raw, cleaned, levels
    (None, None, (None, None, None)),
    ("nan", None, (None, None, None)),
    (" NaN ", None, (None, None, None)),
    ("\tnan", "\tnan", ("\tnan", None, None)),
    ("", "", ("", None, None)),
    ("a", "a", ("a", None, None)),
    ("a..c", "a..c", ("a", "", "c")),
    ("a.b.c.d", "a.b.c.d", ("a", "b", "c")),
    (" a.b ", " a.b ", (" a", "b ", None)),
    ("manual.test.category", "manual.test.category", ("manual", "test", "category")),
]


def test_category_cleanup_and_levels(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, c string")
    cleaned = clean_category_code("c")
    out = df.select("i", cleaned.alias("cc"), *category_levels(cleaned)).orderBy("i").collect()
    for (raw, want_clean, want_levels), row in zip(CASES, out):
        assert row["cc"] == want_clean, raw
        assert (row["category_level_1"], row["category_level_2"], row["category_level_3"]) == want_levels, raw


def test_cleanup_is_idempotent(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "c string")
    once = df.select(clean_category_code("c").alias("c"))
    twice = once.select(clean_category_code("c").alias("c"))
    assert sorted(once.collect(), key=str) == sorted(twice.collect(), key=str)


def test_calendar_fields_ntz_and_zoned(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59, 59, 999999),)], "t timestamp_ntz")
    df = df.withColumn("z", F.col("t").cast("timestamp"))
    for c in ("t", "z"):
        row = df.select(
            event_date(c).alias("d"), event_hour(c).alias("h"), day_of_week(c).alias("w"), minute_bucket(c).alias("m")
        ).first()
        assert row["d"] == dt.date(2024, 1, 1)
        assert row["h"] == 23
        assert row["w"] == 2  # Monday; 1 = Sunday
        assert row["m"] == dt.datetime(2024, 1, 1, 23, 59)
    assert dict(df.select(minute_bucket("t").alias("m")).dtypes)["m"] == "timestamp_ntz"


def test_minute_bucket_ignores_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 5),)], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist locally
        got = df.select(minute_bucket("t").alias("m")).first()["m"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == dt.datetime(2024, 3, 10, 2, 30)


def test_parse_event_time(spark):
    cases = [
        ("2019-10-01 00:00:00 UTC", dt.datetime(2019, 10, 1, 0, 0, 0)),
        ("2019-10-01T01:02:03+03:00", dt.datetime(2019, 9, 30, 22, 2, 3)),
        ("2019-10-01T01:02:03.5Z", dt.datetime(2019, 10, 1, 1, 2, 3, 500000)),
        ("2019-10-01 03:04:05", dt.datetime(2019, 10, 1, 3, 4, 5)),
        ("2019-10-01", dt.datetime(2019, 10, 1)),  # the day is no offset
        ("2019-10", dt.datetime(2019, 10, 1)),
        ("2019-10-01 00:00:00 Europe/Paris", dt.datetime(2019, 9, 30, 22)),
        ("2019-10-01 00:00:00 -0500", dt.datetime(2019, 10, 1, 5)),
        ("2019-10-01 00:00:00 Mars/Olympus", None),
        ("2019-10-01 UTC", None),  # a zone needs a time of day
        ("garbage", None),
        ("", None),
        (None, None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            out = df.select("i", parse_event_time("s").alias("t")).orderBy("i").collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", old)
        assert [r["t"] for r in out] == [c[1] for c in cases], zone


def test_parse_numbers(spark):
    longs = [("12", 12), (" 7 ", 7), ("12.0", 12), ("12.5", None), ("x", None), ("1e3", 1000), (None, None), ("nan", None),
             ("12.0000001", None), ("12.", 12), (".0", 0), ("-7.000", -7), ("1e-19", None), ("1200e-2", 12), ("9223372036854775807", 2**63 - 1),
             ("9223372036854775808", None), ("9223372036854775807.0", 2**63 - 1), (".", None), ("+", None), ("", None), ("1.5e0", None)]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(longs)], "i int, s string")
    got = [r["v"] for r in df.select("i", parse_long("s").alias("v")).orderBy("i").collect()]
    assert got == [c[1] for c in longs]
    prices = [("12.345", Decimal("12.35")), ("-1.005", Decimal("-1.01")), ("nan", None), ("abc", None), ("3", Decimal("3.00"))]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(prices)], "i int, s string")
    got = [r["v"] for r in df.select("i", parse_price("s").alias("v")).orderBy("i").collect()]
    assert got == [c[1] for c in prices]
