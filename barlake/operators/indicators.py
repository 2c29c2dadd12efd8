"""Technical indicators per entity series.

Windows run over a ticker's rows by date; "20-day" means 20 rows. A series is
cut into stretches of ``STRETCH_DAYS`` calendar days, and each stretch is given
the ``LOOKBACK_ROWS`` rows before it, so a window partition is (ticker,
stretch): a ticker with a third of all rows is spread over as many tasks as it
has stretches. (ticker, trade_date) must be unique (see
``operators.flatten.keep_latest``); then a window partition holds at most one
row per calendar day of its stretch.

Rounding chain (kept on purpose): the return is rounded to 6 places before
the volatility uses it; both SMAs are rounded before they are compared; the
20-row volume average is rounded to an integer before relative volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from barlake.functions.numeric import RETURN_TYPE, from_micro_units, half_up_ratio, micro_units
from barlake.functions.windows import with_rows_before

SMA_TYPE = DecimalType(16, 4)

# Longest look-back of the indicators: the 50-row SMA subtracts the running
# sum 50 rows back; the 20-row volatility needs returns 20 rows back, each
# needing the close before it (21 rows).
LOOKBACK_ROWS = 50

# Calendar days of a stretch: about 700 trading days, so the rows before a stretch add about 7 %.
STRETCH_DAYS = 1024


def daily_return(close: Column, prev: Column) -> Column:
    """(close - prev) / prev at 6 places; NULL without a positive previous close."""
    return F.when(prev.isNotNull() & (prev > 0),
                  half_up_ratio(close - prev, prev, 6)).cast(RETURN_TYPE)


def _frame(total: str, count: str, width: int) -> tuple[Column, Column]:
    """Sum and count over the last ``width`` rows from running (prefix) columns.

    frame(i) = running(i) - running(i - width); before the series has
    ``width`` rows the lag is NULL and counts as 0.
    """
    lag_total = F.col(f"_w_lag_{total}_{width}")
    lag_count = F.col(f"_w_lag_{count}_{width}")
    return (F.col(total) - F.coalesce(lag_total, F.lit(0)),
            F.col(count) - F.coalesce(lag_count, F.lit(0)))


def _lags(spec, cols_widths: list[tuple[str, int]]) -> list[Column]:
    return [F.lag(c, k).over(spec).alias(f"_w_lag_{c}_{k}") for c, k in cols_widths]


def _mean(total: Column, count: Column, total_scale: int, scale: int) -> Column:
    """Exact mean (sum / count) rounded half up to ``scale`` places."""
    return half_up_ratio(total.cast(DecimalType(28, total_scale)),
                         count.cast(DecimalType(10, 0)), scale)


def _stddev_micro(s1: Column, s2: Column, n: Column) -> Column:
    """Sample standard deviation from exact sums, in integral micro units.

    sqrt((n * sum(r^2) - sum(r)^2) / (n * (n - 1))), rounded half up to an
    integer; NULL below two values. Exact sums make the result independent
    of summation order.
    """
    n = n.cast(DecimalType(10, 0))
    variance_num = (n * s2.cast(DecimalType(38, 0)) - s1.cast(DecimalType(38, 0))
                    * s1.cast(DecimalType(38, 0))).cast("double")
    variance_den = (n * (n - 1)).cast("double")
    sd = F.floor(F.sqrt(variance_num / variance_den) + F.lit(0.5))
    return F.when(n >= 2, sd)


def add_indicators(staged: DataFrame, partition_col: str = "ticker",
                   order_col: str = "trade_date", built_at: Column | None = None,
                   stretch_days: int | None = STRETCH_DAYS) -> DataFrame:
    """Daily return, SMA 20/50, 20-row volatility, volume average, crossover, relative volume.

    Frame sums come from running (prefix) sums and their lagged values, so
    the cost per row is constant whatever the frame width (a bounded ROW
    frame would re-aggregate the whole frame for every row). Decimal sums
    are exact, so the differences are exact too. The sums start anew with the
    rows before each stretch, so no task holds a whole series; all steps share
    one partitioning and ordering.

    ``stretch_days`` of None cuts no series: the windows run by
    ``partition_col`` as it lies, which needs no shuffle over a table bucketed
    by it (``sources.tables.write_bucketed``). A window partition is then a
    whole series, at most a row a calendar day.
    """
    columns = staged.columns
    if stretch_days is None:
        staged = staged.withColumns({"_stretch": F.lit(0), "_before": F.lit(False)})
    else:
        staged = with_rows_before(staged, partition_col, order_col, stretch_days, LOOKBACK_ROWS)
    w = Window.partitionBy(partition_col).orderBy(order_col) if stretch_days is None else Window.partitionBy(partition_col, "_stretch").orderBy(order_col)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    close, vol = F.col("close_price"), F.col("volume")
    price_scale = staged.schema["close_price"].dataType.scale

    step1 = staged.select(
        "*",
        daily_return(close, F.lag("close_price", 1).over(w)).alias("daily_return"),
        F.sum(close).over(run).alias("_sc"), F.count(close).over(run).alias("_nc"),
        F.sum(vol.cast(DecimalType(20, 0))).over(run).alias("_sv"),
        F.count(vol).over(run).alias("_nv"))
    r = micro_units(F.col("daily_return"))
    step2 = step1.select(
        "*",
        F.sum(r).over(run).alias("_sr"), F.sum(r * r).over(run).alias("_srr"),
        F.count(r).over(run).alias("_nr"),
        *_lags(w, [("_sc", 20), ("_nc", 20), ("_sc", 50), ("_nc", 50), ("_sv", 20), ("_nv", 20)]))
    step3 = step2.select("*", *_lags(w, [("_sr", 20), ("_srr", 20), ("_nr", 20)]))

    sc20, nc20 = _frame("_sc", "_nc", 20)
    sc50, nc50 = _frame("_sc", "_nc", 50)
    sv20, nv20 = _frame("_sv", "_nv", 20)
    sr20, nr20 = _frame("_sr", "_nr", 20)
    srr20, _ = _frame("_srr", "_nr", 20)
    out = step3.where(~F.col("_before")).select(
        *columns, "daily_return",
        _mean(sc20, nc20, price_scale, 4).cast(SMA_TYPE).alias("sma_20"),
        _mean(sc50, nc50, price_scale, 4).cast(SMA_TYPE).alias("sma_50"),
        from_micro_units(_stddev_micro(sr20, srr20, nr20)).alias("volatility_20d"),
        _mean(sv20, nv20, 0, 0).cast("bigint").alias("volume_sma_20"),
    )
    out = out.withColumns({
        "sma_crossover": F.coalesce(F.col("sma_20") > F.col("sma_50"), F.lit(False)),
        "relative_volume": F.when(F.col("volume_sma_20") > 0,
                                  half_up_ratio(F.col("volume").cast(DecimalType(20, 0)),
                                                F.col("volume_sma_20").cast(DecimalType(20, 0)), 4)
                                  ).cast(DecimalType(18, 4)),
    })
    if built_at is not None:
        out = out.withColumn("model_built_at", built_at)
    return out
