"""Data-quality checks."""

from datetime import date, datetime, timedelta

from barlake.operators import quality
from barlake.sources.seed import seed_from_rows
from helpers import silver_rows

AS_OF = datetime(2025, 6, 16, 12, 0)


def test_freshness_status(spark):
    rows = [("A", date(2025, 6, 1), 10, 1, AS_OF - timedelta(hours=23)),
            ("B", date(2025, 6, 1), 10, 1, AS_OF - timedelta(hours=25)),
            ("C", date(2025, 6, 1), 10, 1, AS_OF - timedelta(hours=49))]
    df = silver_rows(spark, rows)
    got = {r.ticker: r.status for r in
           quality.freshness(df, "processed_at", AS_OF, group_by=["ticker"]).collect()}
    assert got == {"A": "pass", "B": "warn", "C": "error"}
    table = quality.freshness(df, "processed_at", AS_OF).collect()
    assert table[0].status == "pass" and table[0].age_hours == 23.0


def test_not_null_unique_accepted(spark):
    seed = seed_from_rows(spark, [("A", "a", "Energy", None), ("A", None, "Crypto", None),
                                  ("B", "b", None, None)])
    nn = {r.column_name: r.null_count
          for r in quality.null_counts(seed, ["ticker", "company_name", "sector"], "dim").collect()}
    assert nn == {"ticker": 0, "company_name": 1, "sector": 1}
    assert [(r.ticker, r.n) for r in quality.duplicate_keys(seed, ["ticker"]).collect()] == [("A", 2)]
    bad = quality.rejected_values(seed, "sector", quality.ACCEPTED_SECTORS).collect()
    assert [(r.sector, r.n) for r in bad] == [("Crypto", 1)]
    assert quality.null_rows(seed, ["sector"]).count() == 1


def test_return_range_boundary(spark):
    df = spark.createDataFrame(
        [("A", date(2025, 1, 1), None), ("A", date(2025, 1, 2), "0.500000"),
         ("A", date(2025, 1, 3), "-0.500001"), ("A", date(2025, 1, 4), "0.500001")],
        "ticker string, trade_date date, daily_return string"
    ).selectExpr("ticker", "trade_date", "cast(daily_return as decimal(18,6)) as daily_return")
    got = sorted(r.trade_date.day for r in quality.return_range_violations(df).collect())
    assert got == [3, 4]
