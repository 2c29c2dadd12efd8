"""Ad-hoc queries over the silver price table."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from barlake.functions.numeric import half_up_ratio
from barlake.functions.windows import series_window


def latest_date(silver: DataFrame, col: str = "trade_date"):
    """Uncorrelated scalar subquery: the newest trade date of the table."""
    return silver.select(F.max(col)).scalar()


def latest_prices(silver: DataFrame) -> DataFrame:
    """Prices of every ticker on the newest trade date, by ticker.

    The scalar subquery is worked out first and filters below the projection.
    """
    return (silver.where(F.col("trade_date") == latest_date(silver))
            .select("ticker", "trade_date", "open_price", "close_price", "volume")
            .orderBy("ticker"))


def top_movers(silver: DataFrame) -> DataFrame:
    """Change from the previous close on the newest date, largest move first.

    Equivalent to a LAG over each whole series filtered to the newest date,
    but planned without a window over the history: the previous close is
    the close at the latest earlier date of each ticker (a partial
    aggregate), joined to the newest rows (one per ticker).
    """
    maxd = latest_date(silver)
    latest = (silver.where(F.col("trade_date") == maxd)
              .select("ticker", "trade_date", "close_price"))
    prev = (silver.where(F.col("trade_date") < maxd)
            .groupBy("ticker")
            .agg(F.max_by("close_price", "trade_date").alias("prev_close")))
    c, p = F.col("close_price"), F.col("prev_close")
    return (latest.join(prev, "ticker")
            .where(p.isNotNull() & (p != 0))
            .select("ticker", "trade_date", "close_price", "prev_close",
                    half_up_ratio((c - p) * 100, p, 2).cast(DecimalType(18, 2)).alias("pct_change"),
                    F.abs(F.try_divide(c - p, p)).alias("_move"))
            .orderBy(F.col("_move").desc(), F.col("ticker"))
            .drop("_move"))


def price_history(silver: DataFrame, ticker: str, n: int = 20) -> DataFrame:
    """The newest ``n`` bars of one ticker (filter pushed to the scan; top-k, no full sort)."""
    return (silver.where(F.col("ticker") == ticker)
            .select("ticker", "trade_date", "open_price", "high_price", "low_price",
                    "close_price", "volume")
            .orderBy(F.col("trade_date").desc())
            .limit(n))


def volume_spikes(silver: DataFrame, lookback: int = 20, threshold: float = 2.0) -> DataFrame:
    """Days whose volume exceeds ``threshold`` times the mean of the previous ``lookback`` rows.

    The current row is excluded from its average. The frame sum is a running
    exact sum lagged by one row minus the same sum lagged by ``lookback + 1``
    rows (constant cost per row). The comparison is done without division
    (volume * n > threshold * sum), so it is exact and has no zero divisor;
    the average and the ratio are exact decimals rounded half up.
    """
    w = series_window()
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = silver.select(
        "ticker", "trade_date", "volume",
        F.sum(F.col("volume").cast(DecimalType(20, 0))).over(run).alias("_s"),
        F.count("volume").over(run).alias("_c"))
    lagged = running.select(
        "ticker", "trade_date", "volume",
        (F.lag("_s", 1).over(w) - F.coalesce(F.lag("_s", lookback + 1).over(w), F.lit(0)))
        .cast(DecimalType(38, 0)).alias("_sv"),
        (F.lag("_c", 1).over(w) - F.coalesce(F.lag("_c", lookback + 1).over(w), F.lit(0)))
        .cast(DecimalType(10, 0)).alias("_n"))
    v = F.col("volume").cast(DecimalType(20, 0))
    k = F.lit(Decimal(str(threshold)))
    return (lagged.where((F.col("_n") > 0) & (F.col("_sv") > 0)
                         & (v * F.col("_n") > k * F.col("_sv")))
            .select("ticker", "trade_date", "volume",
                    half_up_ratio(F.col("_sv"), F.col("_n"), 0).cast("bigint").alias("avg_volume_20d"),
                    half_up_ratio(v * F.col("_n"), F.col("_sv"), 2).cast(DecimalType(18, 2))
                    .alias("relative_volume"))
            .orderBy(F.col("trade_date").desc(), F.col("relative_volume").desc(), F.col("ticker")))


def monthly_average(silver: DataFrame) -> DataFrame:
    """Per ticker and calendar month: average close (2 places), average volume, days."""
    g = (silver.groupBy("ticker", F.trunc("trade_date", "month").alias("month"))
         .agg(F.sum("close_price").cast(DecimalType(28, 4)).alias("_sc"),
              F.count("close_price").alias("_nc"),
              F.sum("volume").cast(DecimalType(28, 0)).alias("_sv"),
              F.count("volume").alias("_nv"),
              F.count(F.lit(1)).alias("trading_days")))
    n = lambda c: F.col(c).cast(DecimalType(20, 0))
    return (g.select("ticker", "month",
                     half_up_ratio(F.col("_sc"), n("_nc"), 2).cast(DecimalType(14, 2)).alias("avg_close"),
                     half_up_ratio(F.col("_sv"), n("_nv"), 0).cast("bigint").alias("avg_volume"),
                     "trading_days")
            .orderBy("ticker", F.col("month").desc()))


def filter_tickers(df: DataFrame, tickers: list[str] | str) -> DataFrame:
    """Rows of the listed tickers (a list or a comma-separated parameter).

    An ``IN`` list on the column: pushed to the Parquet scan, and a
    partition filter when the table is partitioned by ticker.
    """
    from barlake.functions.text import parse_ticker_list
    names = parse_ticker_list(tickers) if isinstance(tickers, str) else list(tickers)
    return df.where(F.col("ticker").isin(names))


def row_count(df: DataFrame) -> DataFrame:
    """``SELECT COUNT(*)`` as a one-row DataFrame (a global aggregate, partial per task)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def first_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """A plain ``LIMIT n`` look at a table."""
    return df.limit(n)
