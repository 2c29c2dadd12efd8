"""Harness queries: every operator family run over the given tables.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Inputs
are the harness tables or data Spark derives from them (the daily bars of
``sources.testbars``), so the work grows with the tables. Reports cast
decimals to double and integers to bigint only in the last select.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.numeric import PRICE_TYPE
from barlake.functions.text import parse_ticker_list
from barlake.functions.windows import calculate_sma
from barlake.operators import adhoc, dashboards, quality
from barlake.operators import indicators as ind
from barlake.operators import marts
from barlake.operators.staging import stage_prices
from barlake.plans import bronze_harness as bh
from barlake.plans.reporting import report
from barlake.sources.testbars import bars_for, read_table

# Fixed values of the harness mapping: the ticker the single-ticker history
# report looks at; the clock of the freshness check.
HISTORY_TICKER = "NATION_7"
RUN_TS = datetime(2001, 11, 6, 12, 0, 0)


def raw_prices(spark: SparkSession, sf_dir: str, tickers: list[str] | None = None) -> DataFrame:
    """Bars in the raw landing shape (decimal(12,4) prices, source and stamps)."""
    bars = bars_for(spark, sf_dir, tickers)
    day = F.col("trade_date").cast("timestamp")
    return bars.select(
        "ticker", "trade_date",
        *[F.col(c).cast(PRICE_TYPE).alias(c)
          for c in ("open_price", "high_price", "low_price", "close_price")],
        "volume",
        F.lit("lineitem").alias("source"),
        (day + F.expr("INTERVAL 18 HOURS")).alias("ingested_at"),
        (day + F.expr("INTERVAL 30 HOURS")).alias("processed_at"),
    )


def dim_from_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    seed = (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias("ticker"),
                    F.concat(F.col("n_name"), F.lit(" Holdings & Co")).alias("company_name"),
                    F.col("r_name").alias("sector"),
                    F.when(F.col("n_nationkey") < 10, F.lit("Large Cap"))
                    .otherwise(F.lit("Mid Cap")).alias("market_cap_category")))
    return marts.dim_stocks(seed)


def staged(spark, sf_dir):
    return stage_prices(raw_prices(spark, sf_dir))


def indicator_rows(spark, sf_dir):
    return ind.add_indicators(staged(spark, sf_dir))


def daily_fact(spark, sf_dir):
    return marts.daily_trading(indicator_rows(spark, sf_dir), dim_from_geography(spark, sf_dir))


def sector_fact(spark, sf_dir):
    return marts.sector_performance(daily_fact(spark, sf_dir))


# --- harness keys ---------------------------------------------------------

def q_staging(spark, sf_dir):
    return report(staged(spark, sf_dir).drop("ingested_at", "processed_at"))


def q_indicators(spark, sf_dir):
    return report(indicator_rows(spark, sf_dir).select(
        "ticker", "trade_date", "close_price", "volume", "daily_return", "sma_20", "sma_50",
        "volatility_20d", "volume_sma_20", "relative_volume", "sma_crossover"))


def q_indicators_split(spark, sf_dir):
    """The same with short stretches: every series is cut into many."""
    return report(ind.add_indicators(staged(spark, sf_dir), stretch_days=100).select(
        "ticker", "trade_date", "close_price", "volume", "daily_return", "sma_20", "sma_50",
        "volatility_20d", "volume_sma_20", "relative_volume", "sma_crossover"))


def q_daily_trading(spark, sf_dir):
    return report(daily_fact(spark, sf_dir))


def q_sector_performance(spark, sf_dir):
    return report(sector_fact(spark, sf_dir))


def q_sma_generic(spark, sf_dir):
    s = staged(spark, sf_dir)
    return report(s.select(
        "ticker", "trade_date",
        calculate_sma("close_price", "ticker", "trade_date", 5).alias("sma_5_close"),
        calculate_sma("volume", "ticker", "trade_date", 10, dtype=s.schema["volume"].dataType)
        .alias("sma_10_volume")))


def q_latest_prices(spark, sf_dir):
    return report(adhoc.latest_prices(raw_prices(spark, sf_dir)))


def q_top_movers(spark, sf_dir):
    return report(adhoc.top_movers(raw_prices(spark, sf_dir)))


def q_price_history(spark, sf_dir):
    return report(adhoc.price_history(raw_prices(spark, sf_dir, [HISTORY_TICKER]), HISTORY_TICKER, 20))


def q_volume_spikes(spark, sf_dir):
    return report(adhoc.volume_spikes(raw_prices(spark, sf_dir)))


def q_monthly_average(spark, sf_dir):
    return report(adhoc.monthly_average(raw_prices(spark, sf_dir)))


def q_dq_not_null(spark, sf_dir):
    raw = raw_prices(spark, sf_dir)
    daily = daily_fact(spark, sf_dir)
    sector = marts.sector_performance(daily)
    dim = dim_from_geography(spark, sf_dir)
    parts = [
        quality.null_counts(raw, ["ticker", "trade_date", "open_price", "close_price"], "stock_prices"),
        quality.null_counts(daily, ["ticker", "trade_date", "close_price", "sector"], "fct_daily_trading"),
        quality.null_counts(sector, ["sector", "trade_date", "stock_count"], "fct_sector_performance"),
        quality.null_counts(dim, ["ticker", "company_name", "sector"], "dim_stocks"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return report(out)


def q_dq_report(spark, sf_dir):
    daily = daily_fact(spark, sf_dir)
    return report(quality.check_report(raw_prices(spark, sf_dir), daily,
                                       marts.sector_performance(daily),
                                       dim_from_geography(spark, sf_dir), RUN_TS))


def _dup_report(df, keys, model):
    dups = quality.duplicate_keys(df, keys)
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return dups.select(F.lit(model).alias("model"), key.alias("key_value"), "n")


def q_dq_unique(spark, sf_dir):
    from barlake.plans.bronze_harness import clean_rows
    dim = _dup_report(dim_from_geography(spark, sf_dir), ["ticker"], "dim_stocks")
    raw = _dup_report(raw_prices(spark, sf_dir), ["ticker", "trade_date"], "stock_prices")
    copies = _dup_report(clean_rows(spark, sf_dir), ["ticker", "trade_date"], "silver_clean")
    return report(dim.unionByName(raw).unionByName(copies))


def q_event_props(spark, sf_dir):
    from barlake.functions.json import json_field
    events = read_table(spark, sf_dir, "events")
    k = json_field(F.col("props"), "k", "bigint")
    return report(events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count(k).alias("with_k"),
        F.sum(k).alias("sum_k"),
        F.min(k).alias("min_k"),
        F.max(k).alias("max_k")))


def q_dq_accepted_values(spark, sf_dir):
    return report(quality.rejected_values(daily_fact(spark, sf_dir), "sector",
                                          quality.ACCEPTED_SECTORS))


def q_dq_return_range(spark, sf_dir):
    return report(quality.return_range_violations(daily_fact(spark, sf_dir)))


def q_dq_freshness(spark, sf_dir):
    f = quality.freshness(raw_prices(spark, sf_dir), "processed_at", RUN_TS, group_by=["ticker"])
    return report(f.withColumn("max_loaded_at",
                               F.date_format("max_loaded_at", "yyyy-MM-dd HH:mm:ss")))


# Fixed value of the harness: a ticker list parameter as a user would pass it.
TICKER_LIST = "NATION_1, nation_3 ,NATION_5,,NATION_24"


def q_ticker_filter(spark, sf_dir):
    rows = adhoc.filter_tickers(raw_prices(spark, sf_dir, parse_ticker_list(TICKER_LIST)), TICKER_LIST)
    return report(rows.groupBy("ticker").agg(F.count(F.lit(1)).alias("days"),
                                             F.max("trade_date").alias("last_date"),
                                             F.sum("volume").alias("total_volume")))


def q_row_count(spark, sf_dir):
    return report(adhoc.row_count(raw_prices(spark, sf_dir)))


def q_sector_heatmap(spark, sf_dir):
    return report(dashboards.sector_heatmap(sector_fact(spark, sf_dir)))


def q_top_gainers(spark, sf_dir):
    return report(dashboards.top_gainers(daily_fact(spark, sf_dir), 5))


def q_crossover_signals(spark, sf_dir):
    return report(dashboards.crossover_signals(daily_fact(spark, sf_dir)))


def q_volatility_by_stock(spark, sf_dir):
    return report(dashboards.volatility_by_stock(daily_fact(spark, sf_dir)))


def q_relative_volume_spikes(spark, sf_dir):
    return report(dashboards.relative_volume_spikes(daily_fact(spark, sf_dir)))


def q_staging_view(spark, sf_dir):
    """The catalog's staging view over a landing table."""
    import uuid

    from barlake.sources import tables
    name = uuid.uuid4().hex
    path = bh._fresh_path(spark, "landing")
    tables.write_silver(tables.conform(raw_prices(spark, sf_dir)), path)
    tables.create_schemas(spark, ["harness_raw", "harness_analytics"])
    tables.create_external_table(spark, f"harness_raw.prices_{name}", path, tables.LANDING_SCHEMA)
    tables.create_staging_view(spark, f"harness_analytics.stg_{name}", f"harness_raw.prices_{name}")
    return report(spark.table(f"harness_analytics.stg_{name}").drop("ingested_at", "processed_at"))


def q_incremental_indicators(spark, sf_dir):
    """Indicators kept by month: built from part of the bars with wrong prices, then revised by the rest."""
    from barlake.plans.incremental import update_indicators
    from barlake.sources.merge import merge_into, touched_partitions, with_partition
    from barlake.sources.merge import read_table as read_parquet
    silver, table = bh._fresh_path(spark, "inc-silver"), bh._fresh_path(spark, "inc-indicators")
    rows = raw_prices(spark, sf_dir)
    late = (F.year("trade_date") == 1996) & (F.month("trade_date") == 3) | (F.year("trade_date") == 1998)
    wrong = rows.where((F.year("trade_date") != 1998) & (F.col("volume") >= 0)).withColumn(
        "close_price", F.when(late, F.col("close_price") + 1).otherwise(F.col("close_price")).cast(PRICE_TYPE)) \
        .withColumn("ingested_at", F.col("ingested_at") - F.expr("INTERVAL 1 DAY"))
    for batch in (wrong, rows.where(late)):
        merge_into(spark, silver, batch)
        months = touched_partitions(with_partition(batch))
        update_indicators(spark, silver, table, months)
    return report(read_parquet(spark, table).select(
        "ticker", "trade_date", "close_price", "volume", "daily_return", "sma_20", "sma_50",
        "volatility_20d", "volume_sma_20", "relative_volume", "sma_crossover"))


def q_bucketed_daily(spark, sf_dir):
    """Staged prices and the dimension in buckets by ticker: indicators and the join to the dimension where the rows lie."""
    import uuid

    from barlake.sources import tables
    name = uuid.uuid4().hex
    prices = tables.write_bucketed(staged(spark, sf_dir), f"bucketed_prices_{name}", 8,
                                   path=bh._fresh_path(spark, "bucketed-prices"))
    dim = tables.write_bucketed(dim_from_geography(spark, sf_dir), f"bucketed_dim_{name}", 8,
                                path=bh._fresh_path(spark, "bucketed-dim"))
    return report(marts.daily_trading(ind.add_indicators(prices, stretch_days=None), dim))


def q_sector_delta(spark, sf_dir):
    """Sector facts kept as partial states: built from wrong daily rows, then brought right by the rows that changed."""
    from barlake.plans.incremental import changed_rows, update_sector_states
    from barlake.sources.tables import stage
    right = stage(spark, daily_fact(spark, sf_dir), "daily")
    late = (F.year("trade_date") == 1996) & (F.month("trade_date") == 3) | (F.year("trade_date") == 1998)
    off = F.when(late & (F.day("trade_date") % 3 == 0), F.col("daily_return") + F.lit(1).cast("decimal(2,0)")) \
        .otherwise(F.col("daily_return")).cast(right.schema["daily_return"].dataType)
    wrong = right.where(~(late & (F.day("trade_date") % 7 == 1))).withColumn("daily_return", off)
    path = bh._fresh_path(spark, "sector-states")
    update_sector_states(spark, path, wrong.limit(0), wrong, wrong)
    states, _ = update_sector_states(spark, path, *changed_rows(wrong, right), right)
    return report(marts.finish_sectors(states))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sector_performance": q_sector_performance,
    "staging": q_staging,
    "indicators": q_indicators,
    "indicators_split": q_indicators_split,
    "daily_trading": q_daily_trading,
    "sma_generic": q_sma_generic,
    "latest_prices": q_latest_prices,
    "top_movers": q_top_movers,
    "price_history": q_price_history,
    "volume_spikes": q_volume_spikes,
    "monthly_average": q_monthly_average,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_return_range": q_dq_return_range,
    "dq_freshness": q_dq_freshness,
    "dq_report": q_dq_report,
    "sector_heatmap": q_sector_heatmap,
    "top_gainers": q_top_gainers,
    "crossover_signals": q_crossover_signals,
    "volatility_by_stock": q_volatility_by_stock,
    "relative_volume_spikes": q_relative_volume_spikes,
    "event_props": q_event_props,
    "ticker_filter": q_ticker_filter,
    "row_count": q_row_count,
    "payload_triage": lambda spark, d: report(bh.q_payload_triage(spark, d)),
    "bronze_roundtrip": lambda spark, d: report(bh.q_bronze_roundtrip(spark, d)),
    "bronze_rejects": lambda spark, d: report(bh.q_bronze_rejects(spark, d)),
    "silver_clean": lambda spark, d: report(bh.q_silver_clean(spark, d)),
    "silver_dedupe": lambda spark, d: report(bh.q_silver_dedupe(spark, d)),
    "silver_upsert": lambda spark, d: report(bh.q_silver_upsert(spark, d)),
    "silver_by_ticker": lambda spark, d: report(bh.q_silver_by_ticker(spark, d)),
    "landing_quarantine": lambda spark, d: report(bh.q_landing_quarantine(spark, d)),
    "table_reload": lambda spark, d: report(bh.q_table_reload(spark, d)),
    "landed_roundtrip": lambda spark, d: report(bh.q_landed_roundtrip(spark, d)),
    "landed_files": lambda spark, d: report(bh.q_landed_files(spark, d)),
    "landed_batches": lambda spark, d: report(bh.q_landed_batches(spark, d)),
    "landed_date": lambda spark, d: report(bh.q_landed_date(spark, d)),
    "run_accounting": lambda spark, d: report(bh.q_run_accounting(spark, d)),
    "staging_view": q_staging_view,
    "incremental_indicators": q_incremental_indicators,
    "bucketed_daily": q_bucketed_daily,
    "sector_delta": q_sector_delta,
    "silver_merge": lambda spark, d: report(bh.q_silver_merge(spark, d)),
}
