"""Records of CSV files read in many splits, against whole-file parsing."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.session import work_path
from clickweir.sources import ingest_csv, read_raw_csv
from clickweir.sources.csv_ingest import MALFORMED
from clickweir.sources.csv_records import UnclosedQuote, line_states, read_records
from test_ingest import HEADER, write_csv


@pytest.fixture
def tiny_splits(spark):
    """Splits of a few dozen bytes, so that records cross them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64b")
    spark.conf.set("spark.sql.files.openCostInBytes", "16b")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def whole_files(spark, path):
    reader = spark.read.option("header", "true").option("quote", '"').option("escape", '"').option("multiLine", True)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, MALFORMED)])
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).schema(schema).csv(path)


def field(rnd):
    text = "".join(rnd.choice(['a', 'bc', ' ', ',', '"', '\n', 'é', '1', '\n\n', '",', ',"']) for _ in range(rnd.randrange(6)))
    if any(c in text for c in ',"\n') or rnd.random() < 0.2:
        return '"' + text.replace('"', '""') + '"'
    return text


def random_csv(rnd, rows, end="\n"):
    lines = ["h1,h2,h3"]
    for _ in range(rows):
        line = ",".join(field(rnd) for _ in range(3 if rnd.random() < 0.95 else rnd.randrange(1, 5)))
        lines.append(line if line else "x")
    return end.join(lines) + rnd.choice(["", end])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_splits_equal_whole_files(spark, tiny_splits, end):
    rnd = random.Random(len(end))
    for rows in (40,):
        path = write_csv(spark, random_csv(rnd, rows, end))
        got, want = read_raw_csv(spark, path), whole_files(spark, path)
        assert got.columns == want.columns
        count = lambda df: Counter((*r[:3], r[3] is None) for r in df.collect())
        assert count(got) == count(want)


def test_one_file_is_many_tasks(spark, tiny_splits):
    text = HEADER + "".join(f'2019-10-{1 + i % 30:02d},view,{i},2,a.b,"two\nlines, {i}",3.5,7,s\n' for i in range(60))
    path = write_csv(spark, text)
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    table = work_path(spark, "test-ingest")
    assert ingest_csv(spark, path, table) == (60, 0)
    got = {r["product_id"]: r["brand"] for r in spark.read.parquet(table).collect()}
    assert got == {i: f"two\nlines, {i}" for i in range(60)}


def test_a_record_over_many_splits(spark, tiny_splits):
    long = "\n".join(f"line {i} of a very long field, with commas" for i in range(30))
    path = write_csv(spark, f'h1,h2\n1,"{long}"\n2,b\n3,"c\nd"\n')
    got = {r["h1"]: r["h2"] for r in read_raw_csv(spark, path).collect()}
    assert got == {"1": long, "2": "b", "3": "c\nd"}


def test_two_fields_of_a_record_hold_line_breaks(spark, tiny_splits):
    one, two = "\n".join(["some lines"] * 12), "\n".join(["other lines"] * 12)
    path = write_csv(spark, f'h1,h2,h3\n1,"{one}","{two}"\n2,"x","y\n"\n')
    got = {r["h1"]: (r["h2"], r["h3"]) for r in read_raw_csv(spark, path).collect()}
    assert got == {"1": (one, two), "2": ("x", "y\n")}


def test_quotes_inside_unquoted_fields_open_nothing(spark, tiny_splits):
    path = write_csv(spark, 'h1,h2\n1,5" disk\n2,a"b"c\n3,"x\ny"\n4,6" disk\n5,z\n')
    got = {r["h1"]: r["h2"] for r in read_raw_csv(spark, path).collect()}
    assert got == {"1": '5" disk', "2": 'a"b"c', "3": "x\ny", "4": '6" disk', "5": "z"}


def test_several_files_each_with_its_header(spark, tiny_splits):
    path = write_csv(spark, 'h1,h2\n1,"a\nb"\n')
    from clickweir.fs import _fs_path

    for k, text in enumerate(['h1,h2\n2,c\n3,"d\ne"\n', "h1,h2\n", "\n\nh1,h2\n4,f\n"]):
        fs, p = _fs_path(spark, f"{path}/more-{k}.csv")
        out = fs.create(p)
        out.write(bytearray(text.encode()))
        out.close()
    got = {r["h1"]: r["h2"] for r in read_raw_csv(spark, path).collect()}
    assert got == {"1": "a\nb", "2": "c", "3": "d\ne", "4": "f"}


def test_an_unclosed_quote_is_an_error(spark):
    path = write_csv(spark, 'h1,h2\n1,"never closed\n2,b\n3,c\n')
    with pytest.raises(UnclosedQuote, match="never closed"):
        read_records(spark, path)
    with pytest.raises(UnclosedQuote, match="bytes over several lines"):
        read_records(spark, write_csv(spark, 'h1,h2\n1,"a\nb\nc"\n'), max_record_bytes=5)


def test_states_of_lines(spark):
    lines = ['a,b', '"a', 'a"', '"a"', 'x,"y', '",', 'a""', '"a""', '"""', '""', 'x"y', 'z","w', '","', 'end",""']
    want = [(False, True), (True, False), (False, False), (False, False), (True, False), (True, False), (False, True), (True, False), (True, False), (False, True),
            (False, False), (True, True), (False, True), (False, False)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string").select("i", line_states(F.col("line")).alias("to")).orderBy("i").collect()
    got = [(r["to"]["outside"], r["to"]["inside"]) for r in rows]
    assert [x for x, g, w in zip(lines, got, want, strict=True) if g != w] == [], got


def test_no_step_of_the_reading_runs_twice(spark):
    path = write_csv(spark, 'h1,h2\n1,"a\nb"\n2,c\n')
    plan = read_records(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan


def test_carriage_returns_at_ends_of_lines_and_inside_of_them(spark):
    path = write_csv(spark, 'h1,h2\r\n1,a\rb\r\n2,"c\r\nd"\r\n3,e\n')
    assert sorted(r["record"] for r in read_records(spark, path).collect()) == ["1,a\rb", '2,"c\r\nd"', "3,e"]
