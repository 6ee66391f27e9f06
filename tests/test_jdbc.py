"""JDBC reader/writer option building. No database is started in this
environment, so these tests stop before a connection is made."""

import pytest

from clickweir.sources.jdbc import FETCH_SIZE, WRITE_BATCH_SIZE, jdbc_options, read_jdbc


def test_options():
    opts = jdbc_options("jdbc:postgresql://db:5432/ecommerce", "raw.events", user="u", password="p",
                        driver="org.postgresql.Driver")
    assert opts == {
        "url": "jdbc:postgresql://db:5432/ecommerce",
        "dbtable": "raw.events",
        "user": "u",
        "password": "p",
        "driver": "org.postgresql.Driver",
    }
    assert (FETCH_SIZE, WRITE_BATCH_SIZE) == (5000, 20000)


def test_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, jdbc_options("jdbc:none", "t"), partition_column="product_id")


def test_bounds_are_read_back_in_the_session_zone(spark):
    """A zoned bound collected in a Tokyo process is rendered as UTC wall clock
    (the session zone), so Spark reads the same instant back."""
    import datetime as dt
    import os
    import time

    from pyspark.sql import functions as F

    from clickweir.sources.jdbc import session_wall_clock

    old = os.environ.get("TZ")
    os.environ["TZ"] = "Asia/Tokyo"
    time.tzset()
    try:
        ts = spark.range(1).select(F.lit("2024-01-01 00:00:00").cast("timestamp").alias("t")).first()["t"]
        assert ts == dt.datetime(2024, 1, 1, 9, 0)  # PySpark renders it in the process zone
        assert session_wall_clock(spark, ts) == dt.datetime(2024, 1, 1, 0, 0)
        assert session_wall_clock(spark, 42) == 42
    finally:
        if old is None:
            os.environ.pop("TZ")
        else:
            os.environ["TZ"] = old
        time.tzset()


def test_ranges_of_a_skewed_column_are_even(spark):
    """The reader is injected: statements and predicates run on a local frame
    of the oracle engine, no database is reached."""
    import datetime as dt

    import duckdb

    from clickweir.sources.jdbc import range_predicates, range_starts_query, read_jdbc_parallel, sql_literal

    con = duckdb.connect()
    # nine tenths of the rows in the last hundredth of the time; some nulls
    con.execute("""
        CREATE TABLE raw AS SELECT i AS id, CASE WHEN i % 50 = 0 THEN NULL
          WHEN i % 10 = 1 THEN TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * i * 10
          ELSE TIMESTAMP '2024-12-01' + INTERVAL 1 SECOND * i END AS event_time FROM range(20000) t(i)
    """)
    seen = []

    def query(spark, options, sql):
        return [r[0] for r in con.execute(sql).fetchall()]

    def read(spark, options, predicates):
        assert options["fetchsize"] == "5000"
        parts = [con.execute(f"SELECT id, event_time FROM {options['dbtable']} WHERE {p}").fetchall() for p in predicates]
        seen.extend(parts)
        return spark.createDataFrame([r for p in parts for r in p], "id long, event_time timestamp_ntz")

    got = read_jdbc_parallel(spark, jdbc_options("jdbc:none", "raw"), "event_time", 16, columns=("id",), query=query, read=read)
    ids = sorted(r["id"] for r in got.collect())
    assert ids == list(range(20000))  # every row in exactly one range
    sizes = [sum(t is not None for _, t in p) for p in seen]
    assert len(sizes) == 16 and max(sizes) <= 2 * min(sizes)
    assert [i for i, p in enumerate(seen) if any(t is None for _, t in p)] == [0]

    # a column of few values, of one value and of none
    con.execute("CREATE TABLE few AS SELECT CASE WHEN i < 90 THEN 7 ELSE i END AS k FROM range(100) t(i)")
    for where, n in (("true", 100), ("k = 7", 90), ("k < 0", 0)):
        table = f"(SELECT * FROM few WHERE {where})"
        predicates = range_predicates("k", query(spark, None, range_starts_query(table, "k", 8)))
        assert sum(con.execute(f"SELECT count(*) FROM {table} WHERE {p}").fetchone()[0] for p in predicates) == n
    assert sql_literal(dt.date(2024, 1, 2)) == "DATE '2024-01-02'" and sql_literal(5) == "5"
    with pytest.raises(TypeError):
        sql_literal("x")
