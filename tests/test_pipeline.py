"""The full daily run on landed fixture documents."""

import json
import os
from datetime import datetime, timedelta, date

import pytest

from barlake.operators.accounting import BronzeUnreadable
from barlake.plans.pipeline import QualityCheckFailed, run_daily
from barlake.sources.seed import seed_from_rows
from helpers import day, doc

SEED = [("AAA", "A & Co", "Energy", "Large Cap"), ("BBB", "B", "Healthcare", "Mid Cap")]


def land(root, ticker, ts, series, day_no="15", text=None, indent=None):
    folder = os.path.join(root, "year=2025", "month=06", f"day={day_no}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{ticker}_202506{day_no}_180000.json"), "w") as f:
        f.write(text or json.dumps(json.loads(doc(ticker, ts, series)), indent=indent))


def series(start, n, base):
    out = {}
    for i in range(n):
        c = base + (i % 5) * 0.01
        out[(start + timedelta(days=i)).isoformat()] = day(o=f"{c:.2f}", h=f"{c + 0.1:.2f}",
                                                           lo=f"{c - 0.1:.2f}", c=f"{c:.2f}",
                                                           v=str(1000 + i))
    return out


def test_daily_run(spark, tmp_path):
    bronze, wh = str(tmp_path / "bronze"), str(tmp_path / "wh")
    land(bronze, "AAA", "2025-06-15T18:00:00+00:00", series(date(2025, 3, 1), 60, 100))
    land(bronze, "BBB", "2025-06-15T18:00:00+00:00", series(date(2025, 3, 1), 60, 50))
    seed = seed_from_rows(spark, SEED)
    res = run_daily(spark, bronze, wh, "2025-06-15", datetime(2025, 6, 15, 20, 0), seed)
    assert res.counts["parsed_days"] == 120 and res.counts["rejected_days"] == 0
    assert res.checks["freshness:stock_prices.processed_at"]["status"] == "pass"
    assert all(v["status"] == "pass" for v in res.checks.values())
    assert spark.read.parquet(res.paths["fct_daily_trading"]).count() == 120
    assert spark.read.parquet(res.paths["fct_sector_performance"]).count() == 2 * 59
    assert spark.table("analytics.stg_stock_prices").count() == 120
    assert spark.table("raw.seed_stock_tickers").count() == 2
    assert spark.table("analytics.fct_daily_trading").count() == 120
    assert spark.table("raw.silver_stock_prices").count() == 120
    n = spark.sql("SELECT count(*) AS n FROM raw.silver_stock_prices WHERE trade_month = 202503").first().n
    assert n == 2 * 31  # two tickers, every day of March


def test_daily_run_fails_on_check(spark, tmp_path):
    bronze, wh = str(tmp_path / "bronze"), str(tmp_path / "wh")
    land(bronze, "AAA", "2025-06-15T18:00:00+00:00", series(date(2025, 3, 1), 10, 100))
    seed = seed_from_rows(spark, [("AAA", "A", "Crypto", "x")])
    with pytest.raises(QualityCheckFailed) as e:
        run_daily(spark, bronze, wh, "2025-06-15", datetime(2025, 6, 15, 20, 0), seed)
    assert e.value.result.checks["accepted_values:fct_daily_trading.sector"] == {
        "failures": 10, "status": "fail"}


def test_command_line(spark, tmp_path, capsys):
    from barlake.cli import main
    bronze, wh = str(tmp_path / "bronze"), str(tmp_path / "wh")
    land(bronze, "AAA", "2025-06-15T18:00:00+00:00", series(date(2025, 3, 1), 30, 100))
    seed = tmp_path / "seed.csv"
    seed.write_text("ticker,company_name,sector,market_cap_category\nAAA,A & Co,Energy,Large Cap\n")
    code = main(["--bronze", bronze, "--warehouse", wh, "--seed", str(seed),
                 "--processing-date", "2025-06-15", "--run-ts", "2025-06-15T20:00:00"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and out["counts"]["parsed_days"] == 30


def test_printed_documents_and_rejects(spark, tmp_path):
    bronze, wh = str(tmp_path / "bronze"), str(tmp_path / "wh")
    days = series(date(2025, 3, 1), 30, 100)
    days["2025-03-31"] = day(c="abc")
    land(bronze, "AAA", "2025-06-15T18:00:00+00:00", days, indent=2)
    land(bronze, "BBB", "2025-06-15T18:00:00+00:00", {}, indent=4)
    res = run_daily(spark, bronze, wh, "2025-06-15", datetime(2025, 6, 15, 20, 0), seed_from_rows(spark, SEED))
    assert {k: res.counts[k] for k in ("documents", "skipped_documents", "rejected_documents", "parsed_days", "rejected_days",
                                       "clean_rows", "final_rows")} == {
        "documents": 2, "skipped_documents": 1, "rejected_documents": 0, "parsed_days": 30, "rejected_days": 1,
        "clean_rows": 30, "final_rows": 30}
    stored = spark.read.parquet(f"{wh}/rejects").collect()
    assert [(r.ticker, r.date_key, r.reject_reason, str(r.processing_date)) for r in stored] == \
        [("AAA", "2025-03-31", "bad_close", "2025-06-15")]


def test_a_day_that_does_not_parse_fails_the_run(spark, tmp_path):
    bronze, wh = str(tmp_path / "bronze"), str(tmp_path / "wh")
    land(bronze, "AAA", "", {}, text="<html>busy</html>")
    with pytest.raises(BronzeUnreadable, match="1 of 1"):
        run_daily(spark, bronze, wh, "2025-06-15", datetime(2025, 6, 15, 20, 0), seed_from_rows(spark, SEED))
    assert not os.path.exists(f"{wh}/silver") and spark.read.parquet(f"{wh}/rejects").count() == 1


def test_a_revision_rewrites_only_the_months_that_it_reaches(spark, tmp_path):
    """A second day of documents gives what one run over both gives, and leaves early months' files alone."""
    bronze, wh = str(tmp_path / "bronze"), str(tmp_path / "wh")
    seed = seed_from_rows(spark, SEED)
    first = series(date(2024, 1, 1), 400, 100)
    land(bronze, "AAA", "2025-06-15T18:00:00+00:00", first)
    land(bronze, "BBB", "2025-06-15T18:00:00+00:00", series(date(2024, 1, 1), 400, 50))
    land(bronze, "AAA", "2025-06-16T18:00:00+00:00", {"2024-08-05": day(o="100.20", h="100.30", lo="100.00", c="100.20", v="7")}, "16")
    res = run_daily(spark, bronze, wh, "2025-06-15", datetime(2025, 6, 16, 20, 0), seed)
    tables = ("raw_stock_prices", "int_stock_indicators", "fct_daily_trading", "fct_sector_performance")

    def files(key):
        return {(d, f) for d, _, names in os.walk(res.paths[key]) for f in names if f.endswith(".parquet")}
    before = {k: files(k) for k in tables}
    run_daily(spark, bronze, wh, "2025-06-16", datetime(2025, 6, 16, 20, 0), seed)
    for k in tables:
        kept = {d.rsplit("=", 1)[1] for d, _ in before[k] & files(k)}
        changed = {d.rsplit("=", 1)[1] for d, _ in before[k] - files(k)}
        assert not kept & changed and "202401" in kept and "202408" in changed
        # 50 rows of look-back: the 50 daily rows after August
        assert changed == ({"202408"} if k == "raw_stock_prices" else {"202408", "202409", "202410"})
    whole = run_daily(spark, bronze, str(tmp_path / "wh2"), None, datetime(2025, 6, 16, 20, 0), seed)
    for k in tables:
        one, two = spark.read.parquet(res.paths[k]), spark.read.parquet(whole.paths[k])
        cols = [c for c in one.columns if c not in ("ingested_at", "processed_at")]
        assert one.select(cols).exceptAll(two.select(cols)).count() == 0 and one.count() == two.count()


def test_preview_and_limit(spark):
    from barlake.operators.adhoc import first_rows
    from barlake.operators.flatten import preview
    df = spark.range(100)
    assert preview(df).count() == 5 and first_rows(df, 10).count() == 10
