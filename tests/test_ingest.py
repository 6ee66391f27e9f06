import datetime as dt
from decimal import Decimal

from clickweir.fs import _fs_path
from clickweir.sources import ingest_csv, normalize, read_raw_csv
from clickweir.session import work_path

DIRTY = """event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session,extra
2019-10-01 00:00:00 UTC,view,44600062,2103807459595387724,,shiseido,35.79,541312140,72d76fde,x
not a time,cart,3900821,2053013552326770905,appliances.environment.water_heater,aqua,33.20,554748717,9333dfbd,y
2019-10-01 00:00:02 UTC,view,bad,2053013552326770905,nan,NA,nan,519107250,,z
2019-10-01 00:00:03 UTC,purchase,17200506,2053013559792632471,furniture.living_room.sofa,,12.345,"",566511c2,w
"""


def write_csv(spark, text):
    path = work_path(spark, "test-csv")
    fs, p = _fs_path(spark, f"{path}/events.csv")
    out = fs.create(p)
    out.write(bytearray(text.encode()))
    out.close()
    return path


def test_dirty_csv_normalizes_without_failing(spark):
    out = normalize(read_raw_csv(spark, write_csv(spark, DIRTY)))
    assert out.columns == [
        "event_time", "event_type", "product_id", "category_id", "category_code", "brand", "price", "user_id",
        "user_session",
    ]
    rows = sorted(out.collect(), key=lambda r: r["event_type"])
    by_type = {r["event_type"]: r for r in rows}
    assert by_type["cart"]["event_time"] is None
    v = [r for r in rows if r["event_type"] == "view"]
    first = [r for r in v if r["product_id"] == 44600062][0]
    assert first["event_time"] == dt.datetime(2019, 10, 1)
    assert first["category_code"] is None  # empty field
    assert first["category_id"] == 2103807459595387724  # above 2^53: parsed exactly
    bad = [r for r in v if r["product_id"] is None][0]
    assert (bad["category_code"], bad["brand"], bad["price"], bad["user_session"]) == (None, None, None, None)
    p = by_type["purchase"]
    assert p["price"] == Decimal("12.35") and p["brand"] is None and p["user_id"] is None


def test_ingest_modes_and_limit(spark):
    csv = write_csv(spark, DIRTY)
    table = work_path(spark, "test-ingest")
    assert ingest_csv(spark, csv, table) == (4, 0)
    assert ingest_csv(spark, csv, table, append=True) == (4, 0)
    assert spark.read.parquet(table).count() == 8
    assert ingest_csv(spark, csv, table, limit=2) == (2, 0)
    got = spark.read.parquet(table).collect()
    # first two rows in the stated order (event_time, then the other columns; nulls last)
    assert sorted(r["event_time"] for r in got) == [dt.datetime(2019, 10, 1, 0, 0, 0), dt.datetime(2019, 10, 1, 0, 0, 2)]


HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"


def test_quotes_commas_and_line_breaks_inside_fields(spark):
    text = HEADER + '2019-10-01,view,1,2,a.b,"acme ""pro"", inc",3.5,7,s\n' + '2019-10-02,view,1,2,a.b,"two\nlines",3.5,7,s\n'
    rows = sorted(normalize(read_raw_csv(spark, write_csv(spark, text))).collect(), key=lambda r: r["event_time"])
    assert [(r["brand"], r["price"], r["user_id"], r["user_session"]) for r in rows] == [
        ('acme "pro", inc', Decimal("3.50"), 7, "s"), ("two\nlines", Decimal("3.50"), 7, "s"),
    ]


def test_malformed_lines_are_loaded_and_counted(spark):
    text = HEADER + "2019-10-01,view,1,2,a.b,x,3.5,7,s\n2019-10-02,view,1\n2019-10-03,view,1,2,a.b,x,3.5,7,s,extra\n"
    for multi_line in (True, False):
        table = work_path(spark, "test-ingest")
        assert ingest_csv(spark, write_csv(spark, text), table, multi_line=multi_line) == (3, 2)
        got = {r["event_time"]: r["user_id"] for r in spark.read.parquet(table).collect()}
        assert got == {dt.datetime(2019, 10, 1): 7, dt.datetime(2019, 10, 2): None, dt.datetime(2019, 10, 3): 7}


def test_default_ingest_keeps_every_row(spark):
    csv = work_path(spark, "test-csv-large")
    n = 100_002
    spark.range(0, n, 1, 4).selectExpr(
        "'2019-10-01 00:00:00 UTC' event_time", "'view' event_type", "id product_id", "1 category_id", "'a' category_code", "'b' brand",
        "1.0 price", "1 user_id", "'s' user_session",
    ).write.option("header", "true").csv(csv)
    table = work_path(spark, "test-ingest-large")
    assert ingest_csv(spark, csv, table) == (n, 0)
    assert spark.read.parquet(table).count() == n


def test_limit_equals_sorting(spark):
    """Nulls last, ties cut anywhere, any limit; no global sort of the rows."""
    import random

    from clickweir.sources.csv_ingest import limit_rows

    rnd = random.Random(1)
    pick = lambda *xs: rnd.choice(xs)
    rows = [(pick(None, dt.datetime(2030, 1, 1, rnd.randrange(4), 0, 0, 5)), pick(None, "a", "b"), pick(None, 1, 2), pick(None, Decimal("1.50"), Decimal("-2.00"))) for _ in range(300)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, s string, i int, d decimal(14,2)").repartition(5)
    ordered = sorted(rows, key=lambda r: tuple((x is None, "" if x is None else x) for x in r))
    for limit in (0, 1, 77, 150, 299, 300, 400):
        got = limit_rows(df, limit, ("t", "s", "i", "d")).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, ordered[:limit]))
    got = [r["s"] for r in limit_rows(df, 130, ("s",)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, sorted((r[1] for r in rows), key=lambda s: (s is None, s or ""))[:130]))
    text = limit_rows(df, 50, ("t",))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in text and "GlobalLimit" not in text and "Exchange" not in text
