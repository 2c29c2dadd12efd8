"""Round trip and invariants on the derived bars (sf0.001)."""

import os

import pytest
from pyspark.sql import functions as F

from barlake.operators import flatten as fl
from barlake.operators import indicators as ind
from barlake.operators.staging import stage_prices
from barlake.plans import harness as h
from barlake.sources import bronze
from barlake.sources.testbars import bars_for

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="harness tables not present")


def clean_documents(bars):
    """One document per (ticker, year) with every bar, no faults."""
    q = lambda v: F.concat(F.lit('"'), v.cast("string"), F.lit('"'))
    entry = F.concat(q(F.col("trade_date")), F.lit(': {"1. open": '), q(F.col("open_price")),
                     F.lit(', "2. high": '), q(F.col("high_price")), F.lit(', "3. low": '),
                     q(F.col("low_price")), F.lit(', "4. close": '), q(F.col("close_price")),
                     F.lit(', "5. volume": '), q(F.col("volume")), F.lit("}"))
    docs = (bars.withColumn("y", F.year("trade_date"))
            .groupBy("ticker", "y")
            .agg(F.array_join(F.sort_array(F.collect_list(entry), False), ", ").alias("s"))
            .select("ticker", F.make_timestamp(F.col("y") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0),
                                               F.lit(0).cast("decimal(8,6)")).alias("ts"),
                    F.concat(F.lit('{"Time Series (Daily)": {'), F.col("s"), F.lit("}}"))
                    .alias("payload")))
    return bronze.envelope(docs, F.col("ticker"), F.col("ts"))


def test_bars_survive_the_bronze_round_trip(spark):
    bars = bars_for(spark, SF)
    silver = fl.bronze_to_silver(clean_documents(bars), "2025-01-01 00:00:00")
    cols = ["ticker", "trade_date", "open_price", "high_price", "low_price", "close_price", "volume"]
    back = silver.select(*cols)
    orig = bars.select("ticker", "trade_date",
                       *[F.col(c).cast("decimal(12,4)").alias(c) for c in cols[2:6]], "volume")
    assert back.count() == orig.count()
    assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0


def test_bar_invariants(spark):
    bars = bars_for(spark, SF)
    bad = bars.where((F.col("low_price") > F.col("open_price")) | (F.col("open_price") > F.col("high_price"))
                     | (F.col("low_price") > F.col("close_price")) | (F.col("close_price") > F.col("high_price")))
    assert bad.count() == 0
    assert bars.groupBy("ticker", "trade_date").count().where("count > 1").count() == 0


def test_indicators_keep_row_count(spark):
    staged = stage_prices(h.raw_prices(spark, SF))
    assert ind.add_indicators(staged).count() == staged.count()
    sector = h.sector_fact(spark, SF)
    assert sector.where("advancing_stocks + declining_stocks > stock_count").count() == 0
