"""The full daily run, stage by stage.

bronze (one processing date; rejects and counts stored by date) -> audit (rows that break the landing rules stored
with the rule) -> silver (merged by key into the touched months) -> raw landing table -> seed dimension -> staging view -> indicators -> daily
fact -> sector fact -> quality checks. Each stage that later stages read is
written to storage under ``warehouse`` first, so lineage is cut at stage
boundaries and a lost executor only recomputes the current stage.
Stages run in order; a failing error-level check raises.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.clock import timestamp_literal
from barlake.operators import accounting, marts, quality
from barlake.plans import incremental as inc
from barlake.sources import bronze, merge, tables


class QualityCheckFailed(RuntimeError):
    pass


@dataclass
class RunResult:
    silver_version: int
    counts: dict = field(default_factory=dict)
    checks: dict = field(default_factory=dict)
    paths: dict = field(default_factory=dict)


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _dim_changed(spark: SparkSession, path: str, new: DataFrame) -> bool:
    """True if the stored dimension says something else than ``new`` (stamps aside)."""
    if not merge.table_exists(spark, path):
        return True
    cols = [c for c in new.columns if c != "loaded_at"]
    old = spark.read.parquet(path).select(cols)
    return not (old.exceptAll(new.select(cols)).isEmpty() and new.select(cols).exceptAll(old).isEmpty())


# Catalog names of the written stages: (schema, table) per output path key.
CATALOG_NAMES = {
    "silver": ("raw", "silver_stock_prices"),
    "raw_stock_prices": ("raw", "stock_prices"),
    "seed_stock_tickers": ("raw", "seed_stock_tickers"),
    "dim_stocks": ("analytics", "dim_stocks"),
    "int_stock_indicators": ("analytics", "int_stock_indicators"),
    "fct_daily_trading": ("analytics", "fct_daily_trading"),
    "fct_sector_performance": ("analytics", "fct_sector_performance"),
}


def register_catalog(spark: SparkSession, paths: dict[str, str], frames: dict[str, DataFrame],
                     months: dict[str, list[int] | None]) -> None:
    """Declare every written stage as an external Parquet table, and register what the run wrote.

    ``months`` names the partitions that the run wrote of each stage (None:
    any). A stage that is declared already gets those and is not dropped. The
    staging view is created over the landing table.
    """
    tables.create_schemas(spark, sorted({db for db, _ in CATALOG_NAMES.values()}))
    for key, (db, name) in CATALOG_NAMES.items():
        part = {"silver": merge.PARTITION_COLUMN, "dim_stocks": None, "seed_stock_tickers": None}.get(key, inc.MONTH)
        tables.register_partitions(spark, f"{db}.{name}", paths[key], frames[key].schema, part, months.get(key))
    tables.create_staging_view(spark, "analytics.stg_stock_prices", "raw.stock_prices")


def run_daily(spark: SparkSession, bronze_root: str, warehouse: str, processing_date: str | None,
              run_ts: datetime, seed: DataFrame,
              as_of: datetime | None = None, catalog: bool = True,
              max_rejected_share: float = accounting.MAX_REJECTED_SHARE, max_refused_share: float = 1.0) -> RunResult:
    """Run every stage for ``processing_date`` (None: every landed date, a backfill);
    ``run_ts`` stamps all outputs."""
    stamp = timestamp_literal(run_ts)
    silver_root = f"{warehouse}/silver"
    paths = {k: f"{warehouse}/{k}" for k in
             ("raw_stock_prices", "seed_stock_tickers", "dim_stocks", "int_stock_indicators", "fct_daily_trading",
              "fct_sector_performance")}

    # bronze -> silver batch; what is refused is stored by processing date, and
    # documents that do not parse fail the run before anything else is written
    docs = bronze.read_bronze(spark, bronze_root, processing_date)
    batch, rejects, counts = accounting.account(docs, stamp)
    (rejects.withColumn("processing_date", F.lit(processing_date or "all")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("processing_date").parquet(f"{warehouse}/rejects"))
    accounting.store_counts(spark, counts, f"{warehouse}/run_counts", processing_date or "all")
    accounting.require_parsed(counts, max_rejected_share)
    # rows that the strict landing table refuses are stored with the rule, and never reach a table
    batch = tables.write_audit(spark, batch, f"{warehouse}/quarantine", processing_date or "all", max_refused_share)
    version = int(processing_date.replace("-", "")) if processing_date else 0
    silver_table = merge.merge_into(spark, silver_root, batch)
    silver = silver_table.drop(merge.PARTITION_COLUMN)

    # raw landing table (strict schema; violations are findings): the months of this batch
    months = merge.touched_partitions(merge.with_partition(batch))
    fresh = not merge.table_exists(spark, paths["raw_stock_prices"])
    if fresh:  # a first run, or models lost: every month of silver
        months = merge.touched_partitions(silver_table)
    raw = inc.write_months(tables.conform(silver), paths["raw_stock_prices"], months).drop(inc.MONTH)
    violations = tables.landing_violations(raw)

    # dimension from the seed, models
    seed_table = _write(seed, paths["seed_stock_tickers"])
    new_dim = marts.dim_stocks(seed_table, stamp)
    rebuilt = fresh or _dim_changed(spark, paths["dim_stocks"], new_dim)
    dim = _write(new_dim, paths["dim_stocks"])
    # the models: only the months that this batch reaches, unless the dimension changed
    table, reached = inc.update_indicators(spark, silver_root, paths["int_stock_indicators"], months, stamp)
    indicators = table.drop(inc.MONTH)
    part = indicators if rebuilt else table.where(F.col(inc.MONTH).isin(reached)).drop(inc.MONTH)
    facts = None if rebuilt else reached
    daily_table = inc.write_months(marts.daily_trading(part, dim), paths["fct_daily_trading"], facts)
    daily = daily_table.drop(inc.MONTH)
    part = daily if rebuilt else daily_table.where(F.col(inc.MONTH).isin(reached)).drop(inc.MONTH)
    sector_table = inc.write_months(marts.sector_performance(part, stamp), paths["fct_sector_performance"], facts,
                                    ("sector", "trade_date"))
    sector = sector_table.drop(inc.MONTH)

    if catalog:
        register_catalog(spark, {**paths, "silver": silver_root},
                         {"silver": silver_table, "raw_stock_prices": inc.with_month(raw),
                          "seed_stock_tickers": seed_table, "dim_stocks": dim,
                          "int_stock_indicators": table, "fct_daily_trading": daily_table,
                          "fct_sector_performance": sector_table},
                         {"silver": months, "raw_stock_prices": months, "int_stock_indicators": reached,
                          "fct_daily_trading": facts, "fct_sector_performance": facts})

    # quality checks: one small DataFrame (one row per check), collected once
    landing = violations.select(
        F.concat(F.lit("landing_"), F.col("check")).alias("check_name"),
        F.concat(F.lit("stock_prices."), F.col("detail")).alias("target"),
        F.col("n").cast("bigint").alias("failures"), F.lit("fail").alias("status"))
    report = quality.check_report(raw, daily, sector, dim, as_of or run_ts).unionByName(landing)
    checks = {f"{r.check_name}:{r.target}": {"failures": r.failures, "status": r.status}
              for r in report.collect()}
    failed = sorted(k for k, v in checks.items() if v["status"] in ("fail", "error"))
    result = RunResult(version, counts, checks, {**paths, "silver": silver_root})
    if failed:
        err = QualityCheckFailed(f"quality checks failed: {failed}")
        err.result = result
        raise err
    return result
