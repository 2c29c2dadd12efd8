"""A day is processed when its tickers are all there or the wait is over."""

import os
import time
from datetime import date, datetime

from barlake.sources.merge import table_exists
from barlake.streaming.completeness import start_complete_days
from helpers import day, doc
from test_streaming import land


def run(spark, tmp_path, tickers, **options):
    q = start_complete_days(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ck"), tickers,
                            processed_at=datetime(2025, 7, 1), **options)
    if options.get("available_now", True):
        q.awaitTermination(120)
        assert q.exception() is None
    return q


def put(tmp_path, ticker, ymd, clock, close="1.00", on="2025-06-12"):
    name = f"{ticker}_{ymd.replace('-', '')}_{clock}.json"
    stamp = f"{ymd}T{clock[:2]}:{clock[2:4]}:{clock[4:]}+00:00"
    land(str(tmp_path / "bronze"), ymd, name, doc(ticker, stamp, {on: day(c=close)}))


def rows(spark, tmp_path):
    path = str(tmp_path / "silver")
    return {(r.ticker, str(r.close_price)) for r in spark.read.parquet(path).collect()} if table_exists(spark, path) else set()


def test_no_release_before_completeness(spark, tmp_path):
    """Missing, repeated, unexpected and late files, over restarts of the job."""
    os.makedirs(tmp_path / "bronze")
    put(tmp_path, "AAA", "2025-06-15", "180000")
    put(tmp_path, "AAA", "2025-06-15", "180100", close="2.00")  # repeated: still one ticker
    put(tmp_path, "ZZZ", "2025-06-15", "180000")  # nobody waits for it
    run(spark, tmp_path, ["aaa ", "BBB", "CCC"])
    assert rows(spark, tmp_path) == set()
    put(tmp_path, "BBB", "2025-06-15", "180000")
    put(tmp_path, "CCC", "2025-06-16", "180000", on="2025-06-13")  # of another day
    run(spark, tmp_path, ["AAA", "BBB", "CCC"])  # restarted from the checkpoint
    assert rows(spark, tmp_path) == set()
    put(tmp_path, "CCC", "2025-06-15", "190000")
    run(spark, tmp_path, ["AAA", "BBB", "CCC"])
    complete = {("AAA", "2.0000"), ("BBB", "1.0000"), ("CCC", "1.0000"), ("ZZZ", "1.0000")}
    assert rows(spark, tmp_path) == complete
    put(tmp_path, "BBB", "2025-06-15", "200000", close="5.00")  # lands behind the release: not lost
    run(spark, tmp_path, ["AAA", "BBB", "CCC"])
    assert rows(spark, tmp_path) == complete - {("BBB", "1.0000")} | {("BBB", "5.0000")}
    assert all(r.trade_date == date(2025, 6, 12) for r in spark.read.parquet(str(tmp_path / "silver")).collect())


def test_an_overdue_day_is_released_without_its_missing_tickers(spark, tmp_path):
    os.makedirs(tmp_path / "bronze")
    put(tmp_path, "AAA", "2025-06-15", "180000")
    q = run(spark, tmp_path, ["AAA", "BBB"], wait_seconds=3, available_now=False, poll="1 second")
    try:
        end = time.time() + 90
        while time.time() < end and not rows(spark, tmp_path):
            time.sleep(1)
            assert q.exception() is None
    finally:
        q.stop()
    assert rows(spark, tmp_path) == {("AAA", "1.0000")}
