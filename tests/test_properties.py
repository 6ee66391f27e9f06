"""Properties against brute-force Python on generated inputs."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickweir.functions import category_levels, clean_category_code
from clickweir.operators import Caps, cap_traffic
from clickweir.schema import SOURCE_SCHEMA

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

codes = st.one_of(st.none(), st.text(alphabet=["a", "B", ".", " ", "n", "N", "\t"], max_size=8),
                  st.sampled_from(["nan", " NaN ", "NAN", "\tnan", "a.b.c.d", ""]))


def py_clean(s):
    return None if s is not None and s.strip(" ").lower() == "nan" else s


def py_levels(s):
    if s is None:
        return (None, None, None)
    parts = s.split(".")
    return tuple(parts[i] if i < len(parts) else None for i in range(3))


@SETTINGS
@given(st.lists(codes, min_size=1, max_size=30))
def test_category_functions_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    cleaned = clean_category_code("c")
    got = df.select("i", cleaned.alias("cc"), *category_levels(cleaned)).orderBy("i").collect()
    for v, r in zip(values, got):
        want = py_clean(v)
        assert r["cc"] == want
        assert (r["category_level_1"], r["category_level_2"], r["category_level_3"]) == py_levels(want)


T0 = dt.datetime(2024, 1, 1)
event = st.tuples(
    st.integers(0, 3),  # minute offset
    st.integers(0, 59),  # second
    st.one_of(st.none(), st.integers(1, 3)),  # user
    st.one_of(st.none(), st.sampled_from(["s1", "s2", "s3"])),  # session
)


def py_cap(rows, caps):
    minute = Counter((u, m) for (m, _, u, _) in rows)
    session = Counter(s for (_, _, _, s) in rows)
    return sorted(
        i for i, (m, _, u, s) in enumerate(rows) if minute[(u, m)] <= caps.per_user_minute and session[s] <= caps.per_session
    )


@SETTINGS
@given(st.lists(event, max_size=60), st.integers(1, 4), st.integers(1, 12))
def test_cap_matches_python(spark, rows, per_minute, per_session):
    caps = Caps(per_minute, per_session)
    data = [
        (T0 + dt.timedelta(minutes=m, seconds=sec), "view", i, 1, "a", "b", None, u, s)
        for i, (m, sec, u, s) in enumerate(rows)
    ]
    df = spark.createDataFrame(data, SOURCE_SCHEMA)
    want = py_cap(rows, caps)
    got = sorted(r["product_id"] for r in cap_traffic(df, caps).select("product_id").collect())
    assert got == want


stamps = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2060, 12, 31))
offsets = st.integers(-12 * 60, 14 * 60).map(lambda m: m - m % 15)


def render(t, offset_min, form):
    if form == 0:
        return t.isoformat(sep=" ") + " UTC"
    if form == 1:
        return t.isoformat() + "Z"
    if form == 2:
        local = t + dt.timedelta(minutes=offset_min)
        sign = "+" if offset_min >= 0 else "-"
        hh, mm = divmod(abs(offset_min), 60)
        return f"{local.isoformat(sep=' ')}{sign}{hh:02d}:{mm:02d}"
    return t.isoformat(sep=" ")


@SETTINGS
@given(st.lists(st.tuples(stamps, offsets, st.integers(0, 3)), min_size=1, max_size=25))
def test_event_time_texts_parse_back_to_utc(spark, items):
    from clickweir.functions import parse_event_time

    texts = [(i, render(t, off, form)) for i, (t, off, form) in enumerate(items)]
    df = spark.createDataFrame(texts, "i int, s string")
    got = [r["t"] for r in df.select("i", parse_event_time("s").alias("t")).orderBy("i").collect()]
    assert got == [t for t, _, _ in items], texts


decimals = st.decimals(min_value=-10**11, max_value=10**11, places=4, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(decimals, min_size=1, max_size=25))
def test_numeric_texts_match_python_decimal(spark, values):
    from decimal import ROUND_HALF_UP, Decimal

    from clickweir.functions import parse_long, parse_price

    rows = [(i, str(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, s string")
    got = df.select("i", parse_price("s").alias("p"), parse_long("s").alias("n")).orderBy("i").collect()
    for v, r in zip(values, got):
        assert r["p"] == Decimal(v).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert r["n"] == (int(v) if v == v.to_integral_value() else None)
