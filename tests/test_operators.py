import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from clickweir.operators import category_metrics, contract_check, count_per_key, funnel_metrics, product_metrics
from clickweir.operators.marts import partial_events
from clickweir.schema import TARGET_SCHEMA

D = dt.date(2024, 1, 1)


def target_rows(spark, rows):
    """rows: (event_time, event_type, product_id, price, user_id)"""
    full = [
        (t, et, pid, 1, "a.b", "x", price, uid, "s", D if t else None, t.hour if t else None, 2 if t else None, "a", "b", None)
        for (t, et, pid, price, uid) in rows
    ]
    return spark.createDataFrame(full, TARGET_SCHEMA)


def test_count_per_key_counts_null_keys(spark):
    data = [(i, k) for i, k in enumerate(["a", "a", None, None, None, "b"])]
    df = spark.createDataFrame(data, "id int, k string")
    got = {r["id"]: r["n"] for r in count_per_key(df, ["k"], "n").collect()}
    assert got == {0: 2, 1: 2, 2: 3, 3: 3, 4: 3, 5: 1}


def test_contract_check_counts_each_violation(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [
        (t, "view", 1, Decimal("1.00"), 1),
        (t + dt.timedelta(microseconds=5), None, 1, Decimal("1.00"), 1),  # null type, sub-second
        (t, "view", 1, Decimal("999999999999.99"), 1),
    ]
    df = target_rows(spark, rows)
    got = contract_check(df).first().asDict()
    assert got["rows"] == 3
    assert got["null_event_type"] == 1 and got["sub_second_event_time"] == 1
    assert got["price_out_of_range"] == 0 and got["null_event_time"] == 0


def test_contract_check_sees_prices_before_the_cast(spark):
    df = target_rows(spark, [(dt.datetime(2024, 1, 1, 10), "view", 1, Decimal("1.00"), 1)])
    wide = df.withColumn("price", F.lit("1000000000000.00").cast("decimal(24,2)"))
    almost = df.withColumn("price", F.lit("999999999999.995").cast("decimal(24,3)"))  # rounds to 10 ** 12
    assert contract_check(wide.unionByName(almost)).first()["price_out_of_range"] == 2


def test_partial_events_roll_up_to_the_same_tables(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [(t, e, p, Decimal(f"{p}.25"), u) for e in ("view", "click", "purchase") for p in (7, 8) for u in (1, 1, 2, None)]
    clean = target_rows(spark, rows)
    partial = partial_events(clean)
    types = ("view", "click", "purchase")
    for f in (product_metrics, category_metrics, funnel_metrics):
        key = lambda r: str(r)
        assert sorted(f(clean, types).collect(), key=key) == sorted(f(partial, types).collect(), key=key), f


def test_funnel_requires_every_earlier_stage(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [
        (t, "view", 1, None, 1), (t, "click", 1, None, 1), (t, "purchase", 1, Decimal("5.00"), 1),  # all three
        (t, "view", 1, None, 2), (t, "purchase", 1, Decimal("5.00"), 2),  # skips click
        (t, "click", 1, None, 3),  # no view
        (t, "view", 1, None, None), (t, "click", 1, None, None),  # null user: not counted
    ]
    got = funnel_metrics(target_rows(spark, rows), ("view", "click", "purchase")).first().asDict()
    assert (got["stage_1_users"], got["stage_2_users"], got["stage_3_users"]) == (2, 1, 1)
    assert got["stage_2_rate"] == 0.5 and got["stage_3_rate"] == 1.0


def test_product_metrics_revenue_counts_purchases_only(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [
        (t, "view", 7, Decimal("3.00"), 1),
        (t, "purchase", 7, Decimal("5.25"), 1),
        (t, "purchase", 7, Decimal("1.00"), 2),
        (t, "purchase", 8, None, 2),
    ]
    got = {r["product_id"]: r for r in product_metrics(target_rows(spark, rows), ("view", "purchase")).collect()}
    assert got[7]["revenue"] == Decimal("6.25") and got[7]["users"] == 2 and got[7]["view_events"] == 1
    assert got[8]["revenue"] == Decimal("0.00") and got[8]["purchase_events"] == 1
