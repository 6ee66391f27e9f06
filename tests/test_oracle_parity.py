"""Every registered query equals its DuckDB statement (sf0.001)."""

import pytest

import __spark_entry__ as entry
from clickweir.oracle_sql import oracle_queries
from clickweir.queries import registry
from conftest import SF_SMALL
from oracle_compare import compare

KEYS = sorted(registry())


def test_every_query_has_an_oracle():
    assert set(registry()) == set(oracle_queries())
    assert set(registry()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck_small, key):
    df = entry.queries()[key](spark, SF_SMALL)
    ok, msg = compare(df, duck_small, entry.oracle_sql()[key])
    assert ok, msg


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["event_time", "event_type", "product_id"]
    assert df.count() == 978
