"""Indicators against a brute-force Python computation on small series."""

import math
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from barlake.functions.windows import calculate_sma
from barlake.operators.indicators import add_indicators
from helpers import staged_rows


def q(x, places):
    return Decimal(x).quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def brute(values):
    """Expected indicator rows for one series [(close, volume), ...]."""
    out, returns = [], []
    for i, (close, vol) in enumerate(values):
        c = Decimal(str(close))
        prev = Decimal(str(values[i - 1][0])) if i else None
        r = q((c - prev) / prev, 6) if prev is not None and prev > 0 else None
        returns.append(r)
        w20 = [Decimal(str(v[0])) for v in values[max(0, i - 19): i + 1]]
        w50 = [Decimal(str(v[0])) for v in values[max(0, i - 49): i + 1]]
        sma20, sma50 = q(sum(w20) / len(w20), 4), q(sum(w50) / len(w50), 4)
        rs = [x for x in returns[max(0, i - 19): i + 1] if x is not None]
        vol20 = None
        if len(rs) >= 2:
            m = [int(x * 10**6) for x in rs]
            n = len(m)
            var = (n * sum(x * x for x in m) - sum(m) ** 2) / (n * (n - 1))
            vol20 = Decimal(math.floor(math.sqrt(var) + 0.5)).scaleb(-6)
        vols = [v[1] for v in values[max(0, i - 19): i + 1]]
        vsma = int(q(Decimal(sum(vols)) / len(vols), 0))
        rel = q(Decimal(vol) / vsma, 4) if vsma > 0 else None
        out.append(dict(daily_return=r, sma_20=sma20, sma_50=sma50, volatility_20d=vol20,
                        volume_sma_20=vsma, relative_volume=rel, sma_crossover=sma20 > sma50))
    return out


def run(spark, series, gap_every=None):
    df = add_indicators(staged_rows(spark, series, gap_every=gap_every))
    rows = df.orderBy("ticker", "trade_date").collect()
    return {t: [r for r in rows if r.ticker == t] for t in series}


def check(got_rows, expected):
    assert len(got_rows) == len(expected)
    for g, e in zip(got_rows, expected):
        for k, v in e.items():
            gv = g[k]
            if v is None or gv is None:
                assert gv is None and v is None, (k, gv, v)
            else:
                assert Decimal(gv) == Decimal(v) if not isinstance(v, bool) else gv == v, (k, gv, v)


def series_of(n, seed):
    vals, price = [], 100 + seed
    for i in range(n):
        price = max(1.0, round(price * (1 + ((i * 37 + seed * 11) % 21 - 10) / 100), 2))
        vals.append((price, 1000 + (i * 53 + seed) % 700))
    return vals


def test_series_lengths_against_brute_force(spark):
    series = {f"T{n}": series_of(n, n) for n in (1, 2, 20, 21, 50, 51)}
    got = run(spark, series)
    for t, vals in series.items():
        check(got[t], brute(vals))


def test_first_rows(spark):
    got = run(spark, {"A": [(10, 100), (11, 100)]})["A"]
    assert got[0].daily_return is None and got[0].volatility_20d is None
    assert got[0].sma_20 == Decimal("10.0000")
    assert got[1].daily_return == Decimal("0.100000")
    assert got[1].volatility_20d is None  # one return only


def test_sma20_excludes_row_one_at_row_21(spark):
    vals = [(1000, 1)] + [(10, 1)] * 20
    got = run(spark, {"A": vals})["A"]
    assert got[19].sma_20 == Decimal(str((1000 + 19 * 10) / 20)).quantize(Decimal("0.0001"))
    assert got[20].sma_20 == Decimal("10.0000")


def test_calendar_gap_counts_rows_not_days(spark):
    vals = series_of(30, 3)
    got = run(spark, {"A": vals}, gap_every=4)["A"]
    check(got, brute(vals))


def test_zero_volume_gives_null_relative_volume(spark):
    got = run(spark, {"A": [(10, 0), (11, 0), (12, 0)]})["A"]
    assert all(r.relative_volume is None for r in got)
    assert all(r.volume_sma_20 == 0 for r in got)


def test_equal_smas_are_not_bullish(spark):
    got = run(spark, {"A": [(10, 5)] * 3})["A"]
    assert all(r.sma_20 == r.sma_50 and r.sma_crossover is False for r in got)


def test_generic_sma_matches_window(spark):
    vals = series_of(12, 7)
    df = staged_rows(spark, {"A": vals})
    got = df.select(calculate_sma("close_price", "ticker", "trade_date", 5).alias("s")) \
        .orderBy(df.trade_date).collect()
    closes = [Decimal(str(v[0])) for v in vals]
    for i, r in enumerate(got):
        w = closes[max(0, i - 4): i + 1]
        assert r.s == q(sum(w) / len(w), 4)


def test_stretches_match_brute_force(spark):
    """Stretches shorter than the look-back, of one row, and gaps of whole stretches."""
    series = {f"S{n}": series_of(n, n) for n in (1, 50, 51, 130, 260)}
    for days in (1, 40, 70, 4096):
        df = add_indicators(staged_rows(spark, series, gap_every=7), stretch_days=days)
        rows = df.orderBy("ticker", "trade_date").collect()
        for t, vals in series.items():
            check([r for r in rows if r.ticker == t], brute(vals))


def keep_partitions(spark, request, key="spark.sql.adaptive.coalescePartitions.enabled"):
    """Small shuffles keep their partitions."""
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    request.addfinalizer(lambda: spark.conf.set(key, before))


def test_a_hot_ticker_lies_in_many_tasks(spark, request):
    """No window partition, and no task, holds a ticker's series; the input is read once."""
    keep_partitions(spark, request)
    staged = staged_rows(spark, {"A": series_of(900, 1), **{f"B{i}": series_of(3, i) for i in range(9)}})
    df = add_indicators(staged, stretch_days=64)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [sum(" in line or "Window [lag(" in line]
    assert windows and all("_stretch#" in line for line in windows)
    tasks = df.withColumn("task", F.spark_partition_id()).where("ticker = 'A'").groupBy("task").count().collect()
    assert len(tasks) >= 3 and max(r["count"] for r in tasks) < 600
