"""Dashboard queries over the daily and sector facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sector_heatmap(sector_perf: DataFrame) -> DataFrame:
    """Average daily return of every sector and date, one row for each (the heatmap's cells).

    Long rows: no list of sectors is needed, and the NULL sector is a row like any other.
    """
    return sector_perf.groupBy("sector", "trade_date").agg(F.max("avg_daily_return").alias("avg_daily_return"))


def top_gainers(daily: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` highest daily returns on the newest date (signed), ticker as tie-break."""
    maxd = daily.select(F.max("trade_date")).scalar()
    return (daily.where((F.col("trade_date") == maxd) & F.col("daily_return").isNotNull())
            .select("ticker", "company_name", "sector", "trade_date", "close_price",
                    "daily_return")
            .orderBy(F.col("daily_return").desc(), F.col("ticker"))
            .limit(k))


def crossover_signals(daily: DataFrame) -> DataFrame:
    """Rows in the bullish state (SMA 20 above SMA 50)."""
    return (daily.where(F.col("sma_crossover"))
            .select("ticker", "trade_date", "close_price", "sma_20", "sma_50"))


def volatility_by_stock(daily: DataFrame) -> DataFrame:
    """Per ticker: newest 20-row volatility and the number of days with one."""
    v = F.col("volatility_20d")
    return (daily.where(v.isNotNull())
            .groupBy("ticker", "sector")
            .agg(F.max("trade_date").alias("last_date"),
                 F.max_by(v, F.col("trade_date")).alias("latest_volatility"),
                 F.max(v).alias("max_volatility"),
                 F.count(v).alias("days")))


def relative_volume_spikes(daily: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Rows whose relative volume (20-row average including the day) exceeds ``threshold``."""
    rv = F.col("relative_volume")
    return (daily.where(rv.isNotNull() & (rv > F.lit(threshold).cast("decimal(18,4)")))
            .select("ticker", "trade_date", "volume", "volume_sma_20", "relative_volume"))
