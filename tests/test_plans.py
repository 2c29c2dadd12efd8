"""Physical-plan properties the scale design relies on (checked at sf0.001)."""

import os
from datetime import date, datetime

import pytest

from barlake.operators import marts, quality
from barlake.operators.indicators import add_indicators
from barlake.operators.staging import stage_prices
from barlake.operators.upsert import upsert
from barlake.plans import harness as h
from helpers import silver_rows

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="harness tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_bars_and_sector_facts_are_hash_aggregates(spark):
    p = plan(h.q_sector_performance(spark, SF))
    assert "SortAggregate" not in p
    final = p[:p.find("Initial Plan")] if "Initial Plan" in p else p
    assert final.count("l_extendedprice") and "_stretch" in final  # windows by stretch, not by ticker
    assert "partial_min" in p and "partial_sum" in p  # map-side pre-aggregation


@needs_data
def test_indicators_scan_the_line_items_once(spark):
    df = h.q_indicators(spark, SF)
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    p = plan(df)
    p = p[:p.find("Initial Plan")]
    assert p.count("FileScan parquet [l_") == 1 and "ReusedExchange" in p


@needs_data
def test_top_movers_needs_no_window(spark):
    p = plan(h.q_top_movers(spark, SF))
    assert "Window" not in p
    assert "Subquery" in p  # newest date as a scalar subquery pushed to the scan


@needs_data
def test_price_history_is_top_k(spark):
    p = plan(h.q_price_history(spark, SF))
    assert "TakeOrderedAndProject(limit=20" in p


@needs_data
def test_scans_read_only_needed_columns(spark):
    p = plan(h.q_row_count(spark, SF))
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in p
    p = plan(h.q_event_props(spark, SF))
    assert "ReadSchema: struct<event_type:string,props:string>" in p


def test_upsert_is_one_aggregate_whatever_the_sizes(spark):
    old = silver_rows(spark, [("A", date(2025, 1, d), 10, 1, datetime(2025, 1, 10))
                              for d in range(1, 5)])
    new = silver_rows(spark, [("A", date(2025, 1, 4), 11, 1, datetime(2025, 1, 11))])
    p = plan(upsert(old, new))
    assert "Join" not in p and "SinglePartition" not in p and p.count("Exchange hashpartitioning") == 1


@needs_data
def test_ticker_filter_reaches_the_suppliers(spark):
    p = plan(h.q_price_history(spark, SF))
    low = p[p.index("partial_min"):]  # below the bars' aggregate
    assert "LeftSemi" in low and "PushedFilters: [In(n_name" in low or "EqualTo(n_name" in low


def test_check_report_scans_each_stored_model_once(spark, tmp_path):
    tables = {}
    raw = silver_rows(spark, [("A", date(2025, 1, d), 10 + d, 1) for d in range(1, 5)])
    dim = spark.createDataFrame([("A", "a", "Energy", "x")], "ticker string, company_name string, sector string, market_cap_category string")
    daily = marts.daily_trading(add_indicators(stage_prices(raw)), dim)
    for name, df in (("raw", raw), ("daily", daily), ("sector", marts.sector_performance(daily)), ("dim", dim)):
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    p = plan(quality.check_report(tables["raw"], tables["daily"], tables["sector"], tables["dim"], datetime(2025, 1, 5)))
    assert p[:p.find("Initial Plan")].count("FileScan parquet") <= 5
