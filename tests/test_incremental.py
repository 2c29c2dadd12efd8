"""Indicators brought up to date by month, with a ticker that halts beside one that trades daily."""

from datetime import date, timedelta

from barlake.operators.indicators import add_indicators
from barlake.operators.staging import stage_prices
from barlake.plans.incremental import affected_months, update_indicators
from barlake.sources.merge import merge_into, touched_partitions, with_partition
from helpers import silver_rows


def test_a_halted_ticker_leaves_the_daily_ones_right(spark, tmp_path):
    silver, table = str(tmp_path / "silver"), str(tmp_path / "indicators")
    halted = [("A", date(2024, 1, d), 10 + d, 5) for d in (2, 3, 4)] + [("A", date(2024, 12, d), 20 + d, 5) for d in (2, 3)]
    daily = [("B", date(2024, 1, 1) + timedelta(days=i), 50 + i % 7 + i / 10, 100 + i) for i in range(366)]
    for rows in (halted + daily, [("A", date(2024, 1, 5), 99, 5)]):
        batch = silver_rows(spark, rows)
        merged = merge_into(spark, silver, batch)
        months = touched_partitions(with_partition(batch))
        got, written = update_indicators(spark, silver, table, months)
    assert written == [202401, 202402, 202403, 202412]
    assert affected_months(merged, months) == (written, [202401, 202402, 202403, 202410, 202411, 202412])
    whole = add_indicators(stage_prices(merged.drop("trade_month")))
    cols = [c for c in whole.columns if c not in ("ingested_at", "processed_at") and "built" not in c and "updated" not in c]
    assert got.count() == whole.count() == 372
    assert got.select(cols).exceptAll(whole.select(cols)).count() == 0
