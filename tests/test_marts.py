"""Dimension join and sector facts."""

from datetime import date
from decimal import Decimal

from barlake.operators import marts
from barlake.operators.indicators import add_indicators
from barlake.sources.seed import read_seed_csv, seed_from_rows
from helpers import staged_rows

SEED = [("A", "Alpha & Sons", "Energy", "Large Cap"),
        ("B", "Beta Inc", "Energy", "Large Cap"),
        ("C", "Gamma", "Healthcare", "Mid Cap")]


def daily(spark, series, seed=SEED):
    ind = add_indicators(staged_rows(spark, series))
    return marts.daily_trading(ind, marts.dim_stocks(seed_from_rows(spark, seed)))


def test_left_join_keeps_unknown_ticker(spark):
    d = daily(spark, {"A": [(10, 1)], "Z": [(5, 1)]})
    rows = {r.ticker: r for r in d.collect()}
    assert rows["A"].sector == "Energy" and rows["A"].company_name == "Alpha & Sons"
    assert rows["Z"].sector is None and rows["Z"].company_name is None
    assert rows["A"].day_of_week == 1  # 2024-01-01 was a Monday; Sunday = 0
    assert (rows["A"].trade_year, rows["A"].trade_month) == (2024, 1)


def test_sector_breadth(spark):
    series = {"A": [(10, 100), (11, 300)],   # +10%
              "B": [(10, 100), (10, 100)],   # zero return: neither side
              "C": [(10, 50)],               # only a first day: sector absent
              "Z": [(10, 10), (9, 20)]}      # no sector: own NULL group
    s = marts.sector_performance(daily(spark, series))
    rows = {r.sector: r for r in s.collect()}
    assert set(rows) == {"Energy", None}
    e = rows["Energy"]
    assert e.trade_date == date(2024, 1, 2)
    assert e.stock_count == 2 and e.advancing_stocks == 1 and e.declining_stocks == 0
    assert e.avg_daily_return == Decimal("0.050000")
    assert e.best_return == Decimal("0.100000") and e.worst_return == Decimal("0.000000")
    assert e.total_volume == 400 and e.avg_volume == 200
    assert e.advance_decline_ratio == Decimal("0.5000")
    assert rows[None].declining_stocks == 1 and rows[None].advance_decline_ratio == Decimal("0")


def test_invariants(spark):
    series = {t: [(10 + (i * 7 + k) % 5, 100 + i) for i in range(30)] for k, t in enumerate("AB")}
    s = marts.sector_performance(daily(spark, series)).collect()
    for r in s:
        assert r.advancing_stocks + r.declining_stocks <= r.stock_count


def test_seed_csv(spark, tmp_path):
    p = tmp_path / "seed.csv"
    p.write_text("ticker,company_name,sector,market_cap_category\n"
                 "ACM,Acme & Sons,Financials,Large Cap\n"
                 "GLX,Globex & Partners,Consumer Staples,Large Cap\n")
    rows = read_seed_csv(spark, str(p)).collect()
    assert [r.company_name for r in rows] == ["Acme & Sons", "Globex & Partners"]
