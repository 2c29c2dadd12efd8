"""Models as named views, so they can be queried with SQL text.

``register_models`` builds the model chain over a silver table and a seed
and registers each model under its usual name. Views are lazy: a query plans
through the whole chain and Catalyst optimises it as one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from barlake.operators import marts
from barlake.operators.indicators import add_indicators
from barlake.operators.staging import stage_prices


def register_models(spark: SparkSession, silver: DataFrame, seed: DataFrame,
                    built_at: Column | None = None, prefix: str = "") -> dict[str, DataFrame]:
    """Register silver, staging, indicators, dimension and facts as temp views."""
    dim = marts.dim_stocks(seed, built_at)
    staged = stage_prices(silver)
    indicators = add_indicators(staged, built_at=built_at)
    daily = marts.daily_trading(indicators, dim)
    views = {
        "silver_stock_prices": silver,
        "stg_stock_prices": staged,
        "int_stock_indicators": indicators,
        "dim_stocks": dim,
        "fct_daily_trading": daily,
        "fct_sector_performance": marts.sector_performance(daily, built_at),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return views
