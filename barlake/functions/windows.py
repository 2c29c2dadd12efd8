"""Window specifications and moving averages over a per-entity series.

Windows are always ``PARTITION BY entity ORDER BY date`` with ROW frames:
"20-day" means 20 rows, not calendar days. Because (entity, date) is unique
after deduplication, one window partition holds at most one row per
calendar day, so its size is bounded by the length of the date range and not
by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from barlake.functions.numeric import half_up_ratio


def series_window(partition_col: str = "ticker", order_col: str = "trade_date") -> WindowSpec:
    return Window.partitionBy(partition_col).orderBy(order_col)


def _exact(col: Column, dtype) -> Column:
    if isinstance(dtype, DecimalType):
        return col.cast(DecimalType(26, dtype.scale))
    if isinstance(dtype, IntegralType):
        return col.cast(DecimalType(26, 0))
    raise TypeError(f"moving averages need an exact (decimal or integral) column, got {dtype}")


def wide_scale(dtype) -> int:
    return dtype.scale if isinstance(dtype, DecimalType) else 0


def rolling_mean(col: str, dtype, spec: WindowSpec, start: int, end: int, scale: int) -> Column:
    """Exact mean of ``col`` over ROWS BETWEEN ``start`` AND ``end``, rounded half up.

    Exact sum / count over the frame: NULLs are ignored, a frame without
    values gives NULL. The frame's sum is the running sum up to its end less
    the running sum before its start, so a row costs the same whatever the
    width (decimal sums are exact, and so is their difference).
    """
    def upto(c: Column, row: int) -> Column:
        return c.over(spec.rowsBetween(Window.unboundedPreceding, row))

    wide = _exact(F.col(col), dtype)
    total = F.coalesce(upto(F.sum(wide), end), F.lit(0)) - F.coalesce(upto(F.sum(wide), start - 1), F.lit(0))
    count = upto(F.count(col), end) - upto(F.count(col), start - 1)
    return F.when(count > 0, half_up_ratio(total.cast(DecimalType(38, wide_scale(dtype))), count.cast(DecimalType(10, 0)), scale))


def calculate_sma(column: str, partition_col: str, order_col: str, window_size: int,
                  dtype=DecimalType(12, 4), scale: int = 4) -> Column:
    """Simple moving average over the last ``window_size`` rows (current included).

    Same four parameters as the reusable SQL macro it replaces, plus the input
    type and the result scale (4 places by default).
    """
    if window_size < 1:
        raise ValueError("window_size must be at least 1")
    spec = series_window(partition_col, order_col)
    return rolling_mean(column, dtype, spec, -(window_size - 1), 0, scale)


def with_rows_before(df: DataFrame, key: str, order: str, days: int, rows: int) -> DataFrame:
    """Cut each ``key`` series into stretches of ``days`` calendar days, each with the ``rows`` rows before it.

    Adds ``_stretch`` and ``_before`` (True for the copied rows). A window over
    (key, _stretch) ordered by ``order`` then sees every row with at least
    ``rows`` predecessors, as far as the series has them, and no task needs a
    whole series.

    A stretch is gathered as one array (at most a row a day, as (key, order) is
    unique), shuffled once by (key, _stretch). Only its last ``rows`` rows go
    on: put in order by ``key``, they give the rows before each later stretch,
    however short the ones in between are, and these join the arrays where
    they lie.
    """
    day = F.datediff(F.col(order), F.lit("1970-01-01").cast("date"))
    # a row without a date is the first of its series, as windows order it
    stretch = F.coalesce(F.floor(day / days), F.lit(-1 << 40)).cast("long").alias("_stretch")
    others = [c for c in df.columns if c not in (key, order)]
    row = F.struct(order, *others).alias("_row")
    series = df.select(key, stretch, row).groupBy(key, "_stretch").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    last = series.select(key, "_stretch", F.slice("_rows", -F.least(F.size("_rows"), F.lit(rows)), rows).alias("_last"))
    # every stretch has a row, so those before one lie in as many stretches
    entries = Window.partitionBy(key).orderBy("_stretch").rowsBetween(-rows, -1)
    earlier = F.flatten(F.collect_list("_last").over(entries))
    before = last.select(F.col(key).alias("_key"), F.col("_stretch").alias("_at"), earlier.alias("_earlier")).select(
        "_key", "_at", F.slice("_earlier", F.greatest(F.size("_earlier") - rows + 1, F.lit(1)), rows).alias("_earlier"))
    whole = series.join(before, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_stretch") == F.col("_at")))
    mark = lambda column, flag: F.transform(column, lambda r: F.struct(r.alias("row"), F.lit(flag).alias("before")))
    each = whole.select(key, "_stretch", F.explode(F.concat(mark("_earlier", True), mark("_rows", False))).alias("_e"))
    return each.select(*[F.col(c) if c == key else F.col(f"_e.row.`{c}`").alias(c) for c in df.columns], "_stretch",
                       F.col("_e.before").alias("_before"))
