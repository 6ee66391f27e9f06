"""Run a Spark frame and a DuckDB statement and compare them as row multisets."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral_value() else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_canon(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(con, sql: str):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_canon(r[i]) for i in order) for r in rel.fetchall())


def compare(df, con, sql: str) -> tuple[bool, str]:
    sc, srows = rows_of_spark(df)
    dc, drows = rows_of_duck(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if srows != drows:
        only_s = list((srows - drows).elements())[:3]
        only_d = list((drows - srows).elements())[:3]
        return False, (
            f"rows differ: spark={sum(srows.values())} duck={sum(drows.values())} "
            f"only_spark={only_s} only_duck={only_d}"
        )
    return True, f"{sum(srows.values())} rows"
