"""Records of CSV text that is read in splits, line breaks inside quotes included.

Where a record ends depends on all quotes before it, so a split that starts in the
middle of a file cannot tell alone. But a line maps the state before it (inside or outside of
quotes) to the state after it, and these maps compose: each line's map is found by
built-in functions, each split's by a running composition over its quoted
lines, and a second one over the splits of a file gives every split the
state it starts in. Then each line knows whether it is a record, and the lines of a
longer record are joined.

A quote opens a field only at the field's start; inside, a doubled quote is text
and a single one closes. Quotes in the middle of an unquoted field are text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweir.fs import delete_at_exit
from clickweir.session import work_path

# A record over several lines may have this many bytes; one that is longer has
# most likely a quote that is never closed.
MAX_RECORD_BYTES = 64 * 1024 * 1024

SPLIT = ("file", "start")


class UnclosedQuote(ValueError):
    """A record over several lines exceeds the bound or the file's end."""


def line_states(line: Column) -> Column:
    """(outside, inside): whether the text after the line is inside of quotes
    if the text before it is outside, and if it is inside."""
    parts = F.split(F.replace(line, F.lit('""'), F.lit("")), '"')
    start = F.struct(F.lit(False).alias("outside"), F.lit(True).alias("inside"), F.lit(True).alias("first"))

    def quote(state: Column, before: Column) -> Column:
        opens = before.endswith(",") | (state["first"] & (before == ""))
        return F.struct(
            (~state["outside"] & opens).alias("outside"), (~state["inside"] & opens).alias("inside"), F.lit(False).alias("first")
        )

    end = F.aggregate(F.slice(parts, 1, F.size(parts) - 1), start, quote)
    return F.when(line.contains('"'), F.struct(end["outside"].alias("outside"), end["inside"].alias("inside"))).otherwise(
        F.struct(F.lit(False).alias("outside"), F.lit(True).alias("inside"))
    )


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines by file, start of the split and number within the task."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"), line_states(F.col("value")).alias("to"),
    )


def has_open_lines(spark: SparkSession, path: str) -> bool:
    """Whether some line leaves a quote open. If none does, every line is a
    record, however the files are split."""
    return not _lines(spark, path).filter("to.outside").isEmpty()


def _copied(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written once to the shared folder, for steps that read them several times."""
    path = work_path(rows.sparkSession, name)
    delete_at_exit(rows.sparkSession, path)  # the result reads it until then
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _split_starts(lines: DataFrame) -> DataFrame:
    """(file, start, begins, opener): the state each split begins in, and, if
    that is inside of quotes, where the record began that is still open. Only
    quoted lines that change some state are moved, without their text."""
    acts = lines.filter("to.outside OR NOT to.inside").select(*SPLIT, "id", "to")
    order = Window.partitionBy(*SPLIT).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    known = _copied(_composed(acts, order), "csv-acts")
    # the map of a whole split, then the composition over a file's splits
    ends = known.groupBy(*SPLIT).agg(F.max_by(F.struct("fixed", "turned"), "id").alias("end"))
    splits = lines.select(*SPLIT).distinct().join(ends, list(SPLIT), "left")
    whole = splits.select(
        *SPLIT,
        F.struct(
            F.coalesce("end.fixed", F.col("end.turned") % 2 == 1, F.lit(False)).alias("outside"),
            F.coalesce("end.fixed", F.col("end.turned") % 2 == 0, F.lit(True)).alias("inside"),
        ).alias("to"),
    )
    by_file = Window.partitionBy("file").orderBy("start")
    through = _composed(whole, by_file.rowsBetween(Window.unboundedPreceding, 0))
    state = F.coalesce("fixed", F.col("turned") % 2 == 1)
    begins = _copied(through.select(*SPLIT, F.coalesce(F.lag(state).over(by_file), F.lit(False)).alias("begins")), "csv-begins")  # one row a split
    # the line that opened what is open at the end of a split
    seen = known.join(begins, list(SPLIT)).withColumn("inside", F.coalesce("fixed", F.col("begins") != (F.col("turned") % 2 == 1)))
    was = F.coalesce(F.lag("inside").over(Window.partitionBy(*SPLIT).orderBy("id")), F.col("begins"))
    starts = seen.withColumn("starts", ~was & F.col("inside"))  # a line that closes one field and opens the next starts no record
    opened = starts.groupBy(*SPLIT).agg(F.max_by("inside", "id").alias("open"), F.max(F.when(F.col("starts"), F.col("id"))).alias("id"))
    last_open = F.when(F.col("open") & F.col("id").isNotNull(), F.struct("start", "id"))
    carried = begins.join(opened, list(SPLIT), "left").withColumn("opener", last_open)
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    return carried.select(*SPLIT, "begins", F.when(F.col("begins"), F.last("opener", ignorenulls=True).over(before)).alias("opener"))


def _composed(maps: DataFrame, window) -> DataFrame:
    """``maps`` with ``fixed`` and ``turned`` of the composition so far."""
    turns = (F.col("to.outside") & ~F.col("to.inside")).cast("int")
    same = F.col("to.outside") == F.col("to.inside")
    counted = maps.withColumn("turned", F.sum(turns).over(window))
    last = F.last(F.when(same, F.struct(F.col("to.outside").alias("state"), F.col("turned").alias("at"))), ignorenulls=True).over(window)
    return counted.withColumn("last", last).withColumn("fixed", F.col("last.state") != ((F.col("turned") - F.col("last.at")) % 2 == 1)).drop("last")


def read_records(spark: SparkSession, path: str, max_record_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """(file, record): the records of all files below ``path`` but each file's
    first, its header. Blank lines outside of quotes are no records. The
    lines are copied once to the shared folder, so that all steps see the same splits, and
    once more with the state of each."""
    lines = _copied(_lines(spark, path), "csv-lines")
    starts = _copied(_split_starts(lines), "csv-starts")  # one row a split
    order = Window.partitionBy(*SPLIT).orderBy("id")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    states = _composed(lines, so_far).join(starts, list(SPLIT))
    after = F.coalesce("fixed", F.col("begins") != (F.col("turned") % 2 == 1))
    states = states.withColumn("after", after).withColumn("before", F.coalesce(F.lag("after").over(order), F.col("begins")))
    own = F.struct("start", "id")
    opener = F.coalesce(F.last(F.when(~F.col("before"), own), ignorenulls=True).over(so_far), F.col("opener"))
    placed = states.select("file", "start", "id", "line", "before", "after", opener.alias("opener"))
    header = lines.filter(F.trim(F.regexp_replace("line", "\r$", "")) != "").groupBy("file").agg(F.min(F.struct("start", "id")).alias("header"))
    # the windows over all lines run once, for the records of one line, the sizes and the longer records
    placed = _copied(placed.join(header, "file").filter(F.col("opener") != F.col("header")).drop("header"), "csv-placed")
    alone = placed.filter(~F.col("before") & ~F.col("after")).select("file", F.col("line").alias("record"))
    pieces = placed.filter(F.col("before") | F.col("after"))
    sizes = pieces.groupBy("file", "opener").agg(F.sum(F.octet_length("line") + 1).alias("bytes"), F.max_by("after", F.struct("start", "id")).alias("open"))
    wrong = sizes.filter((F.col("bytes") > max_record_bytes) | F.col("open")).first()
    if wrong is not None:
        raise UnclosedQuote(f"{wrong['file']}: a record of {wrong['bytes']} bytes over several lines" + (", whose quote is never closed" if wrong["open"] else ""))
    parts = F.array_sort(F.collect_list(F.struct("start", "id", "line")))
    joined = pieces.groupBy("file", "opener").agg(parts.alias("parts")).select("file", F.array_join(F.col("parts.line"), "\n").alias("record"))
    records = alone.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return records.filter(F.col("record") != "")
