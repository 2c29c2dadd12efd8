"""Dimension, daily fact and sector facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from barlake.functions.numeric import RETURN_TYPE, half_up_ratio
from barlake.operators.joins import lookup_join


def dim_stocks(seed: DataFrame, built_at: Column | None = None) -> DataFrame:
    """One row per ticker with its descriptive attributes."""
    out = seed.select("ticker", "company_name", "sector", "market_cap_category")
    if built_at is not None:
        out = out.withColumn("loaded_at", built_at)
    return out


def daily_trading(indicators: DataFrame, dim: DataFrame) -> DataFrame:
    """Indicators left-joined to the dimension; calendar parts added.

    Unmatched tickers keep NULL company and sector. The dimension must be
    unique on ticker (``quality.duplicate_keys``), else rows multiply; it is
    broadcast only when its row count is within the bound.
    """
    d = dim.select("ticker", "company_name", "sector")
    joined = lookup_join(indicators, d, "ticker", "left")
    return joined.select(
        "ticker", "company_name", "sector", "trade_date",
        "open_price", "high_price", "low_price", "close_price", "volume", "daily_range",
        "daily_return", "sma_20", "sma_50", "volatility_20d", "volume_sma_20",
        "relative_volume", "sma_crossover",
        F.year("trade_date").alias("trade_year"),
        F.month("trade_date").alias("trade_month"),
        (F.dayofweek("trade_date") - 1).alias("day_of_week"),  # 0 = Sunday
        *([c for c in ("model_built_at",) if c in indicators.columns]),
    )


# Partial states of a sector's day, by how two of them merge: counts and exact sums add up and can be taken back,
# extremes can only be widened.
STATE_SUMS = ["_rows", "_sum_r", "_n_r", "_sum_v", "_n_v", "_sum_vol", "_n_vol", "stock_count", "advancing_stocks",
              "declining_stocks", "bullish_crossover_count"]
STATE_TYPES = {"_sum_r": DecimalType(28, 6), "_sum_v": DecimalType(28, 0), "_sum_vol": DecimalType(28, 6)}
GROUP = ["sector", "trade_date"]


def sector_states(daily: DataFrame) -> DataFrame:
    """Mergeable partial state per (sector, trade_date); first days of a series excluded.

    A NULL sector is a group of its own. The grouping is a partial + final
    hash aggregate: each map task pre-aggregates, so a hot sector costs one
    partial row per task before the shuffle. Sums over no value are 0.
    """
    r = F.col("daily_return")
    vol = F.col("volatility_20d")

    def total(column, name):
        return F.coalesce(F.sum(column), F.lit(0)).cast(STATE_TYPES[name]).alias(name)

    return (daily.where(r.isNotNull())
            .groupBy(*GROUP)
            .agg(
                F.count(F.lit(1)).alias("_rows"),
                total(r, "_sum_r"),
                F.count(r).alias("_n_r"),
                F.max(r).cast(RETURN_TYPE).alias("best_return"),
                F.min(r).cast(RETURN_TYPE).alias("worst_return"),
                total(F.col("volume"), "_sum_v"),
                F.count("volume").alias("_n_v"),
                total(vol, "_sum_vol"),
                F.count(vol).alias("_n_vol"),
                F.count("ticker").alias("stock_count"),
                F.count_if(r > 0).alias("advancing_stocks"),
                F.count_if(r < 0).alias("declining_stocks"),
                F.count_if(F.col("sma_crossover")).alias("bullish_crossover_count"),
            ))


def merge_states(states: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """States after ``removed`` daily rows left and ``added`` ones came, with ``_lost``.

    Sums and counts are taken back and added. An extreme that was removed and
    that no added row reaches is lost: ``_lost`` marks its group, whose state
    has to be worked out from its rows. Groups without rows go.
    """
    parts = [(states, "kept", 1), (sector_states(removed), "removed", -1), (sector_states(added), "added", 1)]
    union = None
    for part, kind, sign in parts:
        cols = [*GROUP, *[(F.col(c) * sign).cast(STATE_TYPES.get(c, "bigint")).alias(c) for c in STATE_SUMS],
                F.col("best_return").cast(RETURN_TYPE).alias("best_return"),
                F.col("worst_return").cast(RETURN_TYPE).alias("worst_return"), F.lit(kind).alias("_kind")]
        rows = part.select(*cols)
        union = rows if union is None else union.unionByName(rows)
    of = lambda f, c, kind: f(F.when(F.col("_kind") == kind, F.col(c)))
    merged = union.groupBy(*GROUP).agg(
        *[F.sum(c).cast(STATE_TYPES.get(c, "bigint")).alias(c) for c in STATE_SUMS],
        F.max(F.when(F.col("_kind") != "removed", F.col("best_return"))).alias("best_return"),
        F.min(F.when(F.col("_kind") != "removed", F.col("worst_return"))).alias("worst_return"),
        of(F.max, "best_return", "removed").alias("_gone_best"), of(F.min, "worst_return", "removed").alias("_gone_worst"),
        of(F.max, "best_return", "added").alias("_new_best"), of(F.min, "worst_return", "added").alias("_new_worst"))
    no = F.lit(False)
    lost_best = F.coalesce(F.col("_gone_best") >= F.col("best_return"), no) \
        & ~F.coalesce(F.col("_new_best") >= F.col("best_return"), no)
    lost_worst = F.coalesce(F.col("_gone_worst") <= F.col("worst_return"), no) \
        & ~F.coalesce(F.col("_new_worst") <= F.col("worst_return"), no)
    return merged.where(F.col("_rows") > 0).select(
        *GROUP, *STATE_SUMS, "best_return", "worst_return", (lost_best | lost_worst).alias("_lost"))


def finish_sectors(states: DataFrame, built_at: Column | None = None) -> DataFrame:
    """The sector fact from its partial states."""
    n = lambda c: F.col(c).cast(DecimalType(20, 0))

    def mean(total, count, scale):
        return F.when(F.col(count) > 0, half_up_ratio(F.col(total), n(count), scale))

    out = states.select(
        *GROUP,
        mean("_sum_r", "_n_r", 6).cast(RETURN_TYPE).alias("avg_daily_return"),
        F.col("best_return").cast(RETURN_TYPE).alias("best_return"),
        F.col("worst_return").cast(RETURN_TYPE).alias("worst_return"),
        F.when(F.col("_n_v") > 0, F.col("_sum_v").cast("bigint")).alias("total_volume"),
        mean("_sum_v", "_n_v", 0).cast("bigint").alias("avg_volume"),
        mean("_sum_vol", "_n_vol", 6).cast(RETURN_TYPE).alias("avg_volatility"),
        "stock_count", "advancing_stocks", "declining_stocks", "bullish_crossover_count",
        F.when(F.col("stock_count") > 0,
               half_up_ratio(n("advancing_stocks"), n("stock_count"), 4))
        .cast(DecimalType(10, 4)).alias("advance_decline_ratio"),
    )
    if built_at is not None:
        out = out.withColumn("model_built_at", built_at)
    return out


def sector_performance(daily: DataFrame, built_at: Column | None = None) -> DataFrame:
    """Per (sector, trade_date) breadth and averages; first days of a series excluded."""
    return finish_sectors(sector_states(daily), built_at)
