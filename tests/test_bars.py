"""OHLCV bars and the packed order key behind them."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlake.functions.numeric import packed_order_key, unpack_value
from barlake.operators.upsert import upsert
from barlake.sources.testbars import ohlcv
from helpers import silver_rows

TRADE_SCHEMA = "k string, ok bigint, ln int, price decimal(12,2), qty double"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**63 - 1), st.integers(0, 999_999),
                          st.integers(-10**12 + 1, 10**12 - 1)), min_size=1, max_size=30))
def test_packed_key_orders_like_the_tuple(spark, rows):
    df = spark.createDataFrame(rows, "a bigint, b int, c bigint")
    key = packed_order_key([(F.col("a"), 19), (F.col("b"), 6)], F.col("c"), 12)
    got = df.select("a", "b", "c", key.alias("k"), unpack_value(key, 12).alias("v")).collect()
    assert [int(r.v) for r in got] == [r.c for r in got]
    by_key = [(r.a, r.b, r.c) for r in sorted(got, key=lambda r: r.k)]
    assert by_key == sorted(by_key)


def test_packed_key_rejects_out_of_budget(spark):
    df = spark.createDataFrame([(1, 1_000_000, 5)], "a bigint, b int, c bigint")
    key = packed_order_key([(F.col("a"), 19), (F.col("b"), 6)], F.col("c"), 12)
    with pytest.raises(Exception, match="digit budget"):
        df.select(key).collect()
    with pytest.raises(ValueError):
        packed_order_key([(F.col("a"), 19), (F.col("b"), 19)], F.col("c"), 12)


def test_ohlcv_against_brute_force(spark):
    trades = [("X", 5, 2, Decimal("10.00"), 3.0), ("X", 5, 1, Decimal("12.50"), 1.0),
              ("X", 9, 1, Decimal("8.00"), 2.0), ("X", 9, 1, Decimal("7.00"), 4.0),  # tie on (ok, ln)
              ("X", 2, 7, Decimal("11.00"), 1.0), ("Y", 1, 1, Decimal("3.00"), 10.0)]
    df = spark.createDataFrame(trades, TRADE_SCHEMA)
    got = {r.k: r for r in ohlcv(df, ["k"], [("ok", 19), ("ln", 6)], "price", "qty").collect()}
    for k in ("X", "Y"):
        ts = sorted((t for t in trades if t[0] == k), key=lambda t: (t[1], t[2], t[3]))
        r = got[k]
        assert (r.open_price, r.close_price) == (ts[0][3], ts[-1][3])
        assert r.high_price == max(t[3] for t in ts) and r.low_price == min(t[3] for t in ts)
        assert r.volume == int(sum(t[4] for t in ts))


def test_ohlcv_is_a_hash_aggregate(spark):
    df = spark.createDataFrame([("X", 1, 1, Decimal("1.00"), 1.0)], TRADE_SCHEMA)
    plan = ohlcv(df, ["k"], [("ok", 19), ("ln", 6)], "price", "qty") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_upsert_keeps_the_newest(spark):
    old = silver_rows(spark, [("A", date(2025, 1, d), 10 + d, 1, datetime(2025, 1, 10))
                              for d in range(1, 8)])
    new = silver_rows(spark, [("A", date(2025, 1, d), 20 + d, 2, datetime(2025, 1, 12))
                              for d in range(5, 10)]
                      + [("A", date(2025, 1, 3), 99, 3, datetime(2025, 1, 5))])  # older pull, late
    small = sorted(upsert(old, new).collect())
    closes = {r.trade_date.day: r.close_price for r in small}
    assert closes == {1: Decimal("11.0000"), 2: Decimal("12.0000"), 3: Decimal("13.0000"),
                      4: Decimal("14.0000"), 5: Decimal("25.0000"), 6: Decimal("26.0000"),
                      7: Decimal("27.0000"), 8: Decimal("28.0000"), 9: Decimal("29.0000")}


def test_upsert_gives_one_row_for_each_key(spark):
    """Copies in the current table and NULL keys are like any other."""
    d = date(2025, 1, 1)
    old = silver_rows(spark, [("A", d, 1, 1), ("A", d, 1, 1), ("B", d, 2, 1), (None, d, 3, 1), (None, d, 3, 1)])
    for new in ([("B", d, 5, 1, datetime(2025, 1, 2))], [("B", d, 5, 1, datetime(2025, 1, 2)), (None, d, 6, 1, datetime(2025, 1, 2))]):
        got = upsert(old, silver_rows(spark, new))
        assert got.count() == 3 and got.where("ticker = 'B'").first().close_price == 5
    assert got.where("ticker is null").first().close_price == 6
