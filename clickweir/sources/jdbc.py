"""JDBC source and sink: a relational source table in, a warehouse table out.

Reads are split into parallel range queries over a numeric, date or
timestamp ``partition_column``. Where the ranges begin comes from one query on the
database, which deals the column's values into parts of equal size, so a skewed
column gives ranges of about equal size too. Filters and the column list written
on the returned DataFrame are pushed into the JDBC query by Catalyst.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import DataFrame, SparkSession

from clickweir.schema import SOURCE_COLUMNS

# The reference's fetch size for reads and batch size for writes.
FETCH_SIZE = 5000
WRITE_BATCH_SIZE = 20000


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra: str) -> dict[str, str]:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    columns: tuple[str, ...] | None = None,
    fetch_size: int | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """JDBC scan. ``columns`` prunes the query; ``partition_column`` with
    ``bounds`` and ``num_partitions`` runs that many range queries in
    parallel instead of one task."""
    reader = spark.read.format("jdbc").options(**options)
    if fetch_size is not None:
        reader = reader.option("fetchsize", fetch_size)
    if partition_column is not None:
        if bounds is None or num_partitions is None:
            raise ValueError("a partitioned read needs bounds and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", num_partitions)
        )
    df = reader.load()
    return df.select(*columns) if columns else df


def session_wall_clock(spark: SparkSession, value: object) -> object:
    """A collected zoned timestamp (which PySpark renders in the Python
    process's zone) as wall clock in the session zone, the zone Spark reads
    a bound's text in. Other values pass through."""
    if not isinstance(value, dt.datetime) or value.tzinfo is not None:
        return value
    try:
        zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    except (ZoneInfoNotFoundError, ValueError):
        return value
    return value.astimezone(zone).replace(tzinfo=None)


def range_starts_query(table: str, column: str, parts: int) -> str:
    """Standard SQL for the least value of each of ``parts`` equally large parts of
    the column; the database sorts the column, or reads an index of it."""
    dealt = f"SELECT {column} AS v, NTILE({parts}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL"
    return f"SELECT MIN(v) AS lo FROM ({dealt}) dealt GROUP BY part"


def _query(spark: SparkSession, options: dict[str, str], sql: str) -> list:
    """First column of a query that the database computes."""
    opts = {k: v for k, v in options.items() if k != "dbtable"}
    rows = spark.read.format("jdbc").options(**opts).option("query", sql).load().collect()
    return [session_wall_clock(spark, r[0]) for r in rows]


def sql_literal(value: object) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        raise TypeError("the partition column must be a number, a date or a timestamp")
    return str(value)


def range_predicates(column: str, starts: list) -> list[str]:
    """Predicates of which every row meets exactly one: from each start to the
    next. What is under the first start, and nulls, are of the first range,
    so rows that arrive after the starts were taken are read as well. A value that
    fills several parts is one range."""
    cuts = [sql_literal(v) for v in sorted(set(starts))[1:]]
    if not cuts:
        return ["1 = 1"]
    ranges = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *ranges, f"{column} >= {cuts[-1]}"]


def _read_ranges(spark: SparkSession, options: dict[str, str], predicates: list[str]) -> DataFrame:
    """One task a predicate."""
    properties = {k: str(v) for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=properties)


def read_jdbc_parallel(
    spark: SparkSession,
    options: dict[str, str],
    partition_column: str,
    num_partitions: int,
    columns: tuple[str, ...] | None = SOURCE_COLUMNS,
    fetch_size: int = FETCH_SIZE,
    query: Callable = _query,
    read: Callable = _read_ranges,
) -> DataFrame:
    """Read in ``num_partitions`` range queries of about equal size over
    ``partition_column`` (numeric, date or timestamp). ``query`` and ``read`` reach
    the database and can be given by the caller."""
    starts = query(spark, options, range_starts_query(options["dbtable"], partition_column, num_partitions))
    rows = read(spark, {**options, "fetchsize": str(fetch_size)}, range_predicates(partition_column, starts))
    return rows.select(*columns) if columns else rows


def read_jdbc_source(spark: SparkSession, options: dict[str, str], fetch_size: int = FETCH_SIZE, **kw) -> DataFrame:
    """The pruned nine-column read of the incremental job."""
    return read_jdbc(spark, options, columns=SOURCE_COLUMNS, fetch_size=fetch_size, **kw)


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "append",
               batch_size: int = WRITE_BATCH_SIZE, truncate: bool = False,
               max_connections: int | None = None) -> None:
    """Append (or, with ``mode="overwrite", truncate=True``, empty the table
    and load it, keeping its DDL) in batches of ``batch_size`` rows.

    Every write task holds one connection; ``max_connections`` caps them
    (Spark coalesces to that many tasks) so a wide job cannot flood the
    database."""
    writer = df.write.format("jdbc").options(**options).option("batchsize", batch_size)
    if max_connections is not None:
        writer = writer.option("numPartitions", max_connections)
    if truncate:
        writer = writer.option("truncate", "true")
    writer.mode(mode).save()


def delete_load_jdbc(spark: SparkSession, options: dict[str, str], column: str, load: str) -> None:
    """Delete the rows of a load that an earlier attempt sent, by one
    statement of the database."""
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for k, v in options.items():
        if k not in ("url", "dbtable", "driver"):
            properties.setProperty(k, v)
    if "driver" in options:
        jvm.org.apache.spark.util.Utils.classForName(options["driver"], True, False)
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        statement = connection.prepareStatement(f"DELETE FROM {options['dbtable']} WHERE {column} = ?")
        statement.setString(1, load)
        statement.executeUpdate()
    finally:
        connection.close()
