"""Raw CSV ingest: read text, coerce types without failing, load a table.

Every column is read as text (no schema inference), so a bad value in one
row can never fail the job or change a column's type; each column is then
coerced with a tolerant parser and a bad value becomes null. Files are read
in parallel splits, also where fields hold line breaks (see ``csv_records``).
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.fs import delete_at_exit
from clickweir.functions import parse_event_time, parse_long, parse_price
from clickweir.observe import observed
from clickweir.schema import SOURCE_COLUMNS
from clickweir.session import work_path
from clickweir.sources.csv_records import has_open_lines, read_records

# Text a CSV reader of the reference's stack (pandas
# ``read_csv`` defaults) reads as missing in any column.
NA_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Holds the whole line where its fields are more or fewer than the header's.
MALFORMED = "__malformed_line"


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header line, every column as text, plus ``MALFORMED``.

    Fields may be quoted; inside quotes a doubled quote stands for one, and
    commas and line breaks are text. Files are read in splits, whatever their
    size: one pass looks for a line that leaves a quote open, and only if there is
    one, records are put together from lines (``csv_records``). ``multi_line=False``
    leaves that pass out, for files known to have no line breaks in fields. Files
    share the header of the first; their columns go by place."""
    reader = spark.read.option("header", "true").option("quote", '"').option("escape", '"')
    names = reader.option("multiLine", multi_line).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, MALFORMED)])
    if multi_line and has_open_lines(spark, path):
        options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
        fields = F.from_csv("record", _ddl(schema), options)
        return read_records(spark, path).select(fields.alias("r")).select("r.*")
    return reader.option("multiLine", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).schema(schema).csv(path)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)


def _missing_to_null(c: str) -> Column:
    return F.when(F.col(c).isin(list(NA_TEXT)), F.lit(None).cast("string")).otherwise(F.col(c))


def normalize(raw: DataFrame, *extra: Column) -> DataFrame:
    """Keep exactly the nine source columns (and ``extra`` ones) and coerce
    their types.

    Missing text (``NA_TEXT``) becomes null in every column, then:
    ``event_time`` -> UTC wall clock without zone, ids -> bigint,
    ``price`` -> decimal(14,2); a value that does not parse becomes null.
    """
    c = {name: _missing_to_null(name) for name in SOURCE_COLUMNS}
    return raw.select(
        parse_event_time(c["event_time"]).alias("event_time"),
        c["event_type"].alias("event_type"),
        parse_long(c["product_id"]).alias("product_id"),
        parse_long(c["category_id"]).alias("category_id"),
        c["category_code"].alias("category_code"),
        c["brand"].alias("brand"),
        parse_price(c["price"]).alias("price"),
        parse_long(c["user_id"]).alias("user_id"),
        c["user_session"].alias("user_session"),
        *extra,
    )


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written and read again, with their place ``__at``: the task's
    number and the row's in the order they stand in."""
    path = work_path(rows.sparkSession, name)
    delete_at_exit(rows.sparkSession, path)
    rows = rows.withColumn("__at", F.monotonically_increasing_id())
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _boundary(column: DataFrame, wanted: int):
    """(value, rows below it, rows of it) of the one column of ``column``, nulls last:
    the value at which the first ``wanted`` rows end. Values are counted, ranges of
    values sorted and summed apart; one range alone is looked into."""
    (name,) = column.columns
    order = F.col(name).asc_nulls_last()
    counts = column.groupBy(name).agg(F.count(F.lit(1)).alias("__n")).repartitionByRange(order).sortWithinPartitions(order)
    ranges = _numbered(counts, "limit-counts")
    task = F.shiftrightunsigned("__at", 33)
    below = 0
    for r in ranges.groupBy(task.alias("t")).agg(F.sum("__n").alias("n")).orderBy("t").collect():  # one row a range
        if below + r["n"] >= wanted:
            inside = ranges.filter(task == r["t"]).withColumn("__to", F.sum("__n").over(Window.orderBy("__at")))
            last = inside.filter(F.col("__to") >= wanted - below).orderBy("__at").first()
            return last[name], below + last["__to"] - last["__n"], last["__n"]
        below += r["n"]
    return None


def _value(value, dtype: T.DataType) -> Column:
    """A collected value as a literal of its column's type."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(None if value is None else value if isinstance(dtype, T.StringType) else str(value)).cast(dtype)


def limit_rows(df: DataFrame, limit: int, order_by: tuple[str, ...] = SOURCE_COLUMNS) -> DataFrame:
    """The first ``limit`` rows in a stated order, nulls last (Spark has no file
    order; ``limit`` alone would pick arbitrary rows).

    No task merges the rows. They are copied once; column by column, the value at which
    the limit falls is found by counting, among the rows that tie so far. Rows below it are
    kept as they stand, and of those that tie in all columns as many as are missing."""
    rows = _numbered(df, "limit-rows")
    keep, tied, wanted = F.lit(False), F.lit(True), limit
    for name in order_by:
        found = _boundary(rows.filter(tied).select(name), wanted) if wanted > 0 else None
        if found is None:  # all that tie are wanted, or none
            break
        value, below, equal = found
        own = F.col(name)
        less = own.isNotNull() if value is None else own < _value(value, rows.schema[name].dataType)
        keep = keep | (tied & F.coalesce(less, F.lit(False)))
        tied = tied & (own.isNull() if value is None else own.eqNullSafe(_value(value, rows.schema[name].dataType)))
        wanted -= below
        if wanted == equal:
            return rows.filter(keep | tied).drop("__at")
    task = F.shiftrightunsigned("__at", 33)
    for r in rows.filter(tied).groupBy(task.alias("t")).agg(F.count(F.lit(1)).alias("n")).orderBy("t").collect() if wanted > 0 else []:
        if r["n"] >= wanted:
            last = rows.filter(tied & (task == r["t"])).select("__at").orderBy("__at").limit(wanted).agg(F.max("__at")).first()[0]
            return rows.filter(keep | (tied & (F.col("__at") <= last))).drop("__at")
        wanted -= r["n"]
    return rows.filter(keep | tied if wanted > 0 else keep).drop("__at")


class Ingested(NamedTuple):
    rows: int
    malformed: int  # of these, lines with more or fewer fields than the header


def ingest_csv(
    spark: SparkSession,
    csv_path: str,
    table_path: str,
    append: bool = False,
    limit: int | None = None,
    order_by: tuple[str, ...] = SOURCE_COLUMNS,
    multi_line: bool = True,
) -> Ingested:
    """Load a raw CSV into the Parquet source table: every row of it, or the
    first ``limit`` in the stated order.

    ``append=False`` replaces the table (the reference truncates first),
    ``append=True`` adds to it. Malformed lines are loaded with the fields
    they have, and counted. ``multi_line``: see ``read_raw_csv``.
    """
    df = normalize(read_raw_csv(spark, csv_path, multi_line), F.col(MALFORMED).isNotNull().alias(MALFORMED))
    if limit is not None:
        df = limit_rows(df, limit, order_by)
    obs = Observation()
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(MALFORMED)).alias("malformed"))
    counted.drop(MALFORMED).write.mode("append" if append else "overwrite").parquet(table_path)
    got = observed(obs) or {"rows": 0, "malformed": 0}
    return Ingested(int(got["rows"]), int(got["malformed"]))
