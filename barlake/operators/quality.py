"""Data-quality checks. Each returns a DataFrame of findings (empty = pass)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.clock import timestamp_literal

# The sectors the daily fact may carry.
ACCEPTED_SECTORS = ["Technology", "Financials", "Healthcare", "Energy", "Consumer Staples"]

# Freshness limits of the landed price table, in hours.
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48


def null_counts(df: DataFrame, columns: list[str], model: str) -> DataFrame:
    """NULL count per required column, all columns in one pass.

    Returns (model, column_name, null_count), one row per column.
    """
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (agg.unpivot([], columns, "column_name", "null_count")
            .select(F.lit(model).alias("model"), "column_name", "null_count"))


def null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that fail a not-null check on any of ``columns``."""
    cond = None
    for c in columns:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.where(cond)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values present more than once (NULL keys ignored): keys + ``n``.

    A grouped count with partial aggregation, so a key held by many rows
    costs one partial row per map task.
    """
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return (df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def rejected_values(df: DataFrame, column: str, accepted: list[str]) -> DataFrame:
    """Values outside the accepted list with their row counts (NULLs left to null checks)."""
    c = F.col(column)
    return (df.where(c.isNotNull() & ~c.isin(accepted))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n")))


# Fixed value: the largest absolute daily return that is not a finding.
RETURN_LIMIT = 0.50


def return_range_violations(daily: DataFrame, limit: float = RETURN_LIMIT) -> DataFrame:
    """Rows whose absolute daily return exceeds ``limit`` (the test passes when empty)."""
    r = F.col("daily_return")
    return (daily.where(r.isNotNull() & (F.abs(r) > F.lit(limit).cast("decimal(18,6)")))
            .select("ticker", "trade_date", "daily_return"))


def freshness(df: DataFrame, loaded_at: str, as_of: datetime | str | Column,
              warn_hours: int = FRESHNESS_WARN_HOURS, error_hours: int = FRESHNESS_ERROR_HOURS,
              group_by: list[str] | None = None) -> DataFrame:
    """Age of the newest ``loaded_at`` against ``as_of``: status pass / warn / error.

    Without ``group_by`` one row for the table; with it, one row per group.
    """
    now = timestamp_literal(as_of)
    grouped = df.groupBy(*(group_by or []))
    agg = grouped.agg(F.max(loaded_at).alias("max_loaded_at"))
    age_s = F.unix_timestamp(now) - F.unix_timestamp(F.col("max_loaded_at"))
    return agg.select(
        *(group_by or []), "max_loaded_at",
        (age_s / F.lit(3600.0)).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        .when(age_s > error_hours * 3600, F.lit("error"))
        .when(age_s > warn_hours * 3600, F.lit("warn"))
        .otherwise(F.lit("pass")).alias("status"))


# The required (not-null) columns of each checked model.
NOT_NULL_CHECKS = [
    ("stock_prices", ["ticker", "trade_date", "open_price", "close_price"]),
    ("fct_daily_trading", ["ticker", "trade_date", "close_price", "sector"]),
    ("fct_sector_performance", ["sector", "trade_date", "stock_count"]),
    ("dim_stocks", ["ticker", "company_name", "sector"]),
]


def _checks(df: DataFrame, aggs: dict[tuple[str, str], Column], status: dict[tuple[str, str], Column] | None = None) -> DataFrame:
    """(check_name, target, failures, status) rows from one aggregate over ``df``: one scan for all its checks."""
    names = {k: f"c{i}" for i, k in enumerate(aggs)}
    one = df.agg(*[aggs[k].alias(n) for k, n in names.items()])
    rows = []
    for (check, target), n in names.items():
        special = (status or {}).get((check, target))
        state = special(F.col(n)) if special else F.when(F.coalesce(F.col(n), F.lit(0)) > 0, "fail").otherwise("pass")
        failures = F.when(state == "pass", 0).otherwise(1) if special else F.coalesce(F.col(n), F.lit(0))
        rows.append(F.struct(F.lit(check).alias("check_name"), F.lit(target).alias("target"),
                             failures.cast("bigint").alias("failures"), state.alias("status")))
    return one.select(F.inline(F.array(*rows)))


def check_report(raw: DataFrame, daily: DataFrame, sector: DataFrame, dim: DataFrame,
                 as_of: datetime | str | Column) -> DataFrame:
    """Every check of the models as one small DataFrame: (check_name, target, failures, status).

    One aggregate for each model answers all its checks in one scan; only
    uniqueness, which groups, reads the dimension again.
    """
    models = {"stock_prices": raw, "fct_daily_trading": daily,
              "fct_sector_performance": sector, "dim_stocks": dim}
    now = timestamp_literal(as_of)

    def age(newest: Column) -> Column:
        seconds = F.unix_timestamp(now) - F.unix_timestamp(newest)
        return (F.when(newest.isNull() | (seconds > FRESHNESS_ERROR_HOURS * 3600), F.lit("error"))
                .when(seconds > FRESHNESS_WARN_HOURS * 3600, F.lit("warn")).otherwise(F.lit("pass")))

    sector_name, change = F.col("sector"), F.col("daily_return")
    more = {
        "stock_prices": {("freshness", "stock_prices.processed_at"): F.max("processed_at")},
        "fct_daily_trading": {
            ("accepted_values", "fct_daily_trading.sector"):
                F.count_if(sector_name.isNotNull() & ~sector_name.isin(ACCEPTED_SECTORS)),
            ("return_range", "fct_daily_trading.daily_return"):
                F.count_if(change.isNotNull() & (F.abs(change) > F.lit(RETURN_LIMIT).cast("decimal(18,6)")))},
    }
    out = duplicate_keys(dim, ["ticker"]).transform(
        lambda d: _checks(d, {("unique", "dim_stocks.ticker"): F.count("n")}))
    for model, cols in NOT_NULL_CHECKS:
        aggs = {("not_null", f"{model}.{c}"): F.count_if(F.col(c).isNull()) for c in cols}
        out = out.unionByName(_checks(models[model], {**aggs, **more.get(model, {})},
                                      {("freshness", "stock_prices.processed_at"): age}))
    return out
