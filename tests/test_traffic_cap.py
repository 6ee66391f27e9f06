import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickweir.operators import Caps, cap_traffic, clean_events, drop_violators, find_violators, with_minute
from clickweir import fs
from clickweir.operators.traffic_cap import MINUTE_ENTRY, SESSION_ENTRY, VIOLATOR_SCHEMA, possible_matches
from clickweir.schema import SOURCE_SCHEMA
from clickweir.sources import clickstream_source
from conftest import SF_LARGE, SF_MID, SF_SMALL

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def rows(n, user, session, minute=0, start_id=0):
    """n events of one user in one minute of one session."""
    return [
        (T0 + dt.timedelta(minutes=minute, seconds=i % 60, microseconds=start_id + i), "view", 1, 1, "a.b", "x", None, user, session)
        for i in range(n)
    ]


def frame(spark, data):
    return spark.createDataFrame(data, SOURCE_SCHEMA)


def test_minute_cap_boundary(spark):
    # user 1: 30 in one minute (kept); user 2: 31 in one minute (dropped whole)
    data = rows(30, 1, "s1") + rows(31, 2, "s2")
    out = cap_traffic(frame(spark, data), Caps(30, 500))
    got = {r["user_id"]: r["n"] for r in out.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {1: 30}


def test_session_cap_boundary(spark):
    # sessions of 500 and 501 rows, spread over minutes so the minute cap never fires
    a = [r for m in range(25) for r in rows(20, 1, "keep", minute=m, start_id=m * 100)]
    b = [r for m in range(25) for r in rows(20, 2, "drop", minute=m, start_id=m * 100)] + rows(1, 2, "drop", minute=30)
    out = cap_traffic(frame(spark, a + b), Caps(30, 500))
    got = {r["user_session"]: r["n"] for r in out.groupBy("user_session").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"keep": 500}


@pytest.mark.parametrize("n_null", [500, 501])
def test_null_session_is_one_group(spark, n_null):
    # n_null rows with null session from many users and minutes: one group
    data = [r for u in range(n_null) for r in rows(1, 100 + u, None, minute=u % 50)]
    out = cap_traffic(frame(spark, data), Caps(30, 500))
    assert out.count() == (n_null if n_null <= 500 else 0)


def test_null_user_is_one_group_per_minute(spark):
    data = [r for s in range(31) for r in rows(1, None, f"s{s}")]
    out = cap_traffic(frame(spark, data), Caps(30, 500))
    assert out.count() == 0


def test_caps_use_counts_taken_before_either_cap(spark):
    # session of 5 rows (cap 4) where 3 rows share one user-minute (cap 2):
    # applied one after the other, 2 rows would survive; together, none do.
    data = rows(3, 1, "s", minute=0) + rows(1, 1, "s", minute=1) + rows(1, 1, "s", minute=2)
    out = cap_traffic(frame(spark, data), Caps(2, 4))
    assert out.count() == 0
    # and rows over one cap count toward the other: 3 in a minute + 2 elsewhere, session cap 5
    out = cap_traffic(frame(spark, data), Caps(2, 5))
    assert out.count() == 2


def random_events(spark, n, seed):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        user = rnd.choice([None, 1, 2, 3, 4, 5])
        session = rnd.choice([None, "a", "b", "c", "d", "e", "f"])
        t = T0 + dt.timedelta(minutes=rnd.randrange(5), seconds=rnd.randrange(60), microseconds=i)
        data.append((t, "view", i, 1, "a", "b", None, user, session))
    return frame(spark, data)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("caps", [Caps(1, 4), Caps(3, 40), Caps(30, 500)])
def test_joins_agree_with_counting_by_hand(spark, seed, caps):
    df = random_events(spark, 400, seed)
    broadcast = cap_traffic(df, caps)
    shuffled = drop_violators(df, find_violators(df, caps), broadcast_bytes=0)
    key = lambda r: r["product_id"]
    ra, rb = (sorted(x.collect(), key=key) for x in (broadcast, shuffled))
    rows_in = with_minute(df).collect()
    minutes = Counter((r["user_id"], r["event_minute"]) for r in rows_in)
    sessions = Counter(r["user_session"] for r in rows_in)
    want = sorted(
        r["product_id"]
        for r in rows_in
        if minutes[r["user_id"], r["event_minute"]] <= caps.per_user_minute and sessions[r["user_session"]] <= caps.per_session
    )
    assert ra == rb and [r["product_id"] for r in ra] == want
    # capping again changes nothing
    assert sorted(cap_traffic(broadcast, caps).collect(), key=key) == ra


def test_fixture_counts_mid(spark):
    src = clickstream_source(spark, SF_MID)
    assert clean_events(src).count() == 9785
    assert clean_events(src, Caps(1, 4)).count() == 7951


def test_fixture_default_caps_drop_null_session_rows(spark):
    """At sf0.1 the null-session group (969 rows) is over 500 and is dropped whole."""
    src = clickstream_source(spark, SF_LARGE)
    assert clean_events(src).count() == 96888
    v = find_violators(src.filter("event_time is not null and product_id is not null"), Caps(30, 500))
    assert (v.minute_keys, v.session_keys) == (0, 1)


def test_violator_sizes_are_measured(spark):
    # sessions "long-session" (12 bytes) and null over cap 2; one user-minute over cap 2
    data = rows(3, 1, "long-session") + [r for u in range(3) for r in rows(1, 10 + u, None, minute=5 + u)]
    v = find_violators(frame(spark, data), Caps(2, 2))
    assert (v.minute_keys, v.session_keys, v.session_text_bytes) == (1, 2, 12)
    # one budget for both tables
    assert v.hashed_bytes == MINUTE_ENTRY + 2 * SESSION_ENTRY + 24
    a = drop_violators(frame(spark, data), v, broadcast_bytes=v.hashed_bytes)
    b = drop_violators(frame(spark, data), v, broadcast_bytes=v.hashed_bytes - 1)
    assert a.count() == b.count() == 0


def test_lazy_scratch_is_deleted(spark):
    df = frame(spark, rows(3, 1, "s"))
    assert cap_traffic(df, Caps(2, 2)).count() == 0
    paths = [path for _, path in fs._scratch]
    assert paths and all(fs.path_exists(spark, p) for p in paths)
    fs.drop_scratch()
    assert not any(fs.path_exists(spark, p) for p in paths) and fs._scratch == []


def test_bloom_split_excludes_no_violator(spark):
    """Whatever the size of the filter, the same rows are left; rows it
    excludes meet no exchange."""
    df = clickstream_source(spark, SF_SMALL)
    caps = Caps(1, 4)
    v = find_violators(df, caps)
    want = sorted(map(str, drop_violators(df, v).collect()))
    for words in (1, 64, 1 << 18):
        out = drop_violators(df, v, broadcast_bytes=0, bloom_words=words)
        assert sorted(map(str, out.collect())) == want
    keys = spark.read.schema(VIOLATOR_SCHEMA).parquet(v.path).filter("by_minute = 0")
    marked = possible_matches(df, keys, ("user_session",), "maybe")
    share = marked.join(keys.select("user_session"), marked["user_session"].eqNullSafe(keys["user_session"]), "left_semi").filter("NOT maybe").count()
    assert share == 0
    assert marked.filter("NOT maybe").count() > 0
