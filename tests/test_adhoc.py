"""Ad-hoc and dashboard queries: values against brute force, and their order."""

from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from barlake.operators import adhoc, dashboards, marts
from barlake.operators.indicators import add_indicators
from barlake.operators.staging import stage_prices
from barlake.sources.seed import seed_from_rows
from helpers import silver_rows

START = date(2024, 1, 1)


def fixture(spark):
    rows = []
    for k, t in enumerate(["C", "A", "B"]):
        for i in range(45):
            if t == "B" and i == 44:
                continue  # B misses the newest date
            close = 10 + ((i * 7 + k * 3) % 11) * 0.5
            vol = 100 + ((i * 13 + k) % 9) * 40 + (900 if i % 17 == 5 else 0)
            rows.append((t, START + timedelta(days=i), close, vol))
    return silver_rows(spark, rows), rows


def test_latest_prices_sorted(spark):
    silver, _ = fixture(spark)
    got = adhoc.latest_prices(silver).collect()
    assert [r.ticker for r in got] == ["A", "C"]
    assert all(r.trade_date == START + timedelta(days=44) for r in got)


def test_top_movers_against_lag(spark):
    silver, rows = fixture(spark)
    got = adhoc.top_movers(silver).collect()
    last = START + timedelta(days=44)
    expect = []
    for t in ("A", "C"):
        series = sorted((r for r in rows if r[0] == t), key=lambda r: r[1])
        c, p = Decimal(str(series[-1][2])), Decimal(str(series[-2][2]))
        expect.append((t, (c - p) / p))
    expect.sort(key=lambda e: (-abs(e[1]), e[0]))
    assert [r.ticker for r in got] == [e[0] for e in expect]
    for r, (_, ch) in zip(got, expect):
        assert r.trade_date == last
        assert r.pct_change == (ch * 100).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def test_price_history_newest_first(spark):
    silver, _ = fixture(spark)
    got = adhoc.price_history(silver, "B", 20).collect()
    assert len(got) == 20
    assert [r.trade_date for r in got] == [START + timedelta(days=43 - i) for i in range(20)]


def test_volume_spikes_against_brute_force(spark):
    silver, rows = fixture(spark)
    got = [(r.ticker, r.trade_date, r.avg_volume_20d, r.relative_volume)
           for r in adhoc.volume_spikes(silver).collect()]
    expect = []
    for t in ("A", "B", "C"):
        series = sorted((r for r in rows if r[0] == t), key=lambda r: r[1])
        for i, r in enumerate(series):
            prev = [x[3] for x in series[max(0, i - 20): i]]
            if not prev or sum(prev) == 0:
                continue
            avg = Decimal(sum(prev)) / len(prev)
            if Decimal(r[3]) / avg > 2:
                expect.append((t, r[1], int(avg.quantize(Decimal(1), rounding=ROUND_HALF_UP)),
                               (Decimal(r[3]) / avg).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)))
    expect.sort(key=lambda e: (-e[1].toordinal(), -e[3], e[0]))
    assert got == expect and got


def test_monthly_average_order_and_values(spark):
    silver, rows = fixture(spark)
    got = adhoc.monthly_average(silver).collect()
    keys = [(r.ticker, r.month) for r in got]
    assert keys == sorted(keys, key=lambda k: (k[0], -k[1].toordinal()))
    jan_a = [r for r in rows if r[0] == "A" and r[1].month == 1]
    g = next(r for r in got if r.ticker == "A" and r.month == date(2024, 1, 1))
    assert g.trading_days == len(jan_a)
    avg = sum(Decimal(str(r[2])) for r in jan_a) / len(jan_a)
    assert g.avg_close == avg.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def test_dashboards(spark):
    silver, _ = fixture(spark)
    raw = silver.withColumnRenamed("source", "source")
    seed = seed_from_rows(spark, [("A", "a", "Energy", "x"), ("B", "b", "Energy", "x"),
                                  ("C", "c", "Healthcare", "x")])
    daily = marts.daily_trading(add_indicators(stage_prices(raw)), seed)
    sector = marts.sector_performance(daily)
    heat = dashboards.sector_heatmap(sector)
    assert heat.columns == ["sector", "trade_date", "avg_daily_return"]
    assert sorted(map(tuple, heat.collect())) == sorted(map(tuple, sector.select(*heat.columns).collect()))
    unknown = sector.limit(1).withColumn("sector", F.lit(None).cast("string"))
    assert dashboards.sector_heatmap(unknown).count() == 1  # the NULL sector is a row too
    top = dashboards.top_gainers(daily, 1).collect()
    assert len(top) == 1
    best = max((r for r in daily.collect() if r.trade_date == START + timedelta(days=44)),
               key=lambda r: (r.daily_return, [-ord(c) for c in r.ticker]))
    assert top[0].ticker == best.ticker
    assert dashboards.crossover_signals(daily).count() == daily.where("sma_crossover").count()
    assert dashboards.volatility_by_stock(daily).count() == 3
    spikes = dashboards.relative_volume_spikes(daily, 1.5).collect()
    assert all(r.relative_volume > Decimal("1.5") for r in spikes)
