"""Sector facts by delta; S7: bucketed tables."""

import glob
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barlake.operators import marts
from barlake.operators.indicators import add_indicators
from barlake.operators.staging import stage_prices
from barlake.plans import incremental as inc
from barlake.sources import tables
from helpers import silver_rows

DIM = "ticker string, company_name string, sector string, market_cap_category string"


def prices(rnd, tickers="ABCDE", days=90):
    return [(t, date(2024, 1, 1) + timedelta(days=i), 50 + rnd.randrange(40), 100 + rnd.randrange(9)) for t in tickers for i in range(days)]


def dim_rows(spark):
    return spark.createDataFrame([("A", "a", "Energy", "x"), ("B", "b", "Energy", "x"), ("C", "c", "Health", "x")], DIM)


def daily_rows(spark, rows):
    return marts.daily_trading(add_indicators(stage_prices(silver_rows(spark, rows))), dim_rows(spark))


def same(a, b):
    cols = a.columns
    return a.count() == b.count() and a.exceptAll(b.select(cols)).isEmpty() and b.select(cols).exceptAll(a).isEmpty()


@pytest.mark.parametrize("seed", [1, 2])
def test_revisions_equal_the_whole_aggregate(spark, tmp_path, seed):
    """Late, changed and withdrawn rows, extremes among them; sectors that are NULL, come and go."""
    rnd, path = random.Random(seed), str(tmp_path / "states")
    rows = prices(rnd, "ABZ")
    before = tables.stage(spark, daily_rows(spark, rows))
    inc.update_sector_states(spark, path, before.limit(0), before, before)
    for _ in range(2):
        rows = [(t, d, p + rnd.randrange(9) if rnd.random() < 0.1 else p, v) for t, d, p, v in rows if rnd.random() > 0.1]
        rows += [r for r in prices(rnd, "C", 40) if rnd.random() < 0.5 and ("C", r[1]) not in {x[:2] for x in rows}]
        after = tables.stage(spark, daily_rows(spark, rows))
        states, _ = inc.update_sector_states(spark, path, *inc.changed_rows(before, after), after)
        assert same(marts.sector_performance(after), marts.finish_sectors(states))
        before = after


def test_only_touched_months_are_written_and_only_lost_groups_read(spark, tmp_path):
    path = str(tmp_path / "states")
    rows = prices(random.Random(3), "AB")
    daily = tables.stage(spark, daily_rows(spark, rows))
    inc.update_sector_states(spark, path, daily.limit(0), daily, daily)
    files = {f for f in glob.glob(f"{path}/*/*.parquet")}
    day = date(2024, 2, 10)
    one = daily.where((F.col("trade_date") == day) & (F.col("ticker") == "A"))
    lower = one.withColumn("volume", F.lit(1).cast("bigint"))
    after = daily.where((F.col("trade_date") != day) | (F.col("ticker") != "A")).unionByName(lower)
    removed, added = inc.changed_rows(daily, after)
    assert removed.count() == added.count() == 1
    # the return stays: nothing is lost, so the daily rows given are not needed
    states, months = inc.update_sector_states(spark, path, removed, added, daily.limit(0))
    assert months == [202402] and same(marts.sector_performance(after), marts.finish_sectors(states))
    kept = {f for f in files if "month_key=202402" not in f}
    assert kept and kept == {f for f in glob.glob(f"{path}/*/*.parquet") if "month_key=202402" not in f}
    none, months = inc.update_sector_states(spark, path, removed.limit(0), added.limit(0), daily.limit(0))
    assert months == [] and none.count() == states.count()


def test_a_lost_extreme_marks_its_group(spark):
    daily = daily_rows(spark, prices(random.Random(4), "AB", 5))
    states = marts.sector_states(daily)
    low = daily.where("daily_return is not null").orderBy("daily_return").limit(1)
    got = marts.merge_states(states, low, low.limit(0)).where("_lost").collect()
    assert [r.trade_date for r in got] == [low.first().trade_date]
    assert marts.merge_states(states, low, low).where("_lost").count() == 0
    assert marts.merge_states(states, daily, daily.limit(0)).count() == 0  # groups without rows go


def test_bucketed_tables_need_no_exchange(spark, tmp_path):
    """Windows by ticker and the join to the dimension run where the rows lie; a bucket is one sorted file."""
    rows = silver_rows(spark, prices(random.Random(5)) + [("A", date(2025, 1, 1), 5, 1, datetime(2025, 1, 2))])
    silver = tables.write_bucketed(stage_prices(rows), "bucketed_silver", 4, path=str(tmp_path / "silver"))
    dim = tables.write_bucketed(dim_rows(spark), "bucketed_dim", 4, path=str(tmp_path / "dim"))
    assert len(glob.glob(str(tmp_path / "silver" / "*.parquet"))) <= 4
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = marts.daily_trading(add_indicators(silver, stretch_days=None), dim)
        p = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in p and "Window" in p and "SortMergeJoin" in p
        assert same(got, marts.daily_trading(add_indicators(stage_prices(rows)), dim_rows(spark)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    again = tables.write_bucketed(stage_prices(rows).limit(3), "bucketed_silver", 4, path=str(tmp_path / "silver"))
    assert again.count() == 3
