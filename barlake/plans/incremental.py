"""The indicator table kept by month, brought up to date for revised months only.

An indicator looks back ``LOOKBACK_ROWS`` rows. After a merge that touched
some months, the rows to work out anew are those of the touched months and,
for each ticker, the next ``LOOKBACK_ROWS`` rows after each of them. Which
months that is follows from the number of rows of each (ticker, month), an
aggregate of the narrow key columns. A month is rewritten for all tickers, so
prices are read for those months and the months before them that hold the
look-back of any ticker, whichever ticker they are rewritten for.

The sector fact can be kept by delta instead: its partial states are stored by
month, and a revision takes the old rows back and adds the new ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.operators import marts
from barlake.operators.indicators import LOOKBACK_ROWS, add_indicators
from barlake.operators.staging import stage_prices
from barlake.sources import tables
from barlake.sources.merge import PARTITION_COLUMN, read_table, table_exists, touched_partitions

MONTH = "month_key"  # partition column of the model tables: yyyyMM as an integer


def affected_months(silver: DataFrame, touched: list[int], rows: int = LOOKBACK_ROWS) -> tuple[list[int], list[int]]:
    """(months to write, months to read): lists bounded by the calendar.

    A month is affected if for some ticker fewer than ``rows`` rows lie
    between it and a touched month before it; it needs, for every ticker,
    the months that hold the ``rows`` rows before its first.
    """
    m = F.col(PARTITION_COLUMN)
    counts = silver.groupBy("ticker", m).agg(F.count("*").alias("n"))
    series = Window.partitionBy("ticker").orderBy(m)
    running = F.sum("n").over(series.rowsBetween(Window.unboundedPreceding, 0))
    at = counts.select("ticker", m, "n", running.alias("upto"), m.isin(touched).alias("touched"))
    last = F.max(F.when(F.col("touched"), F.col("upto"))).over(series.rowsBetween(Window.unboundedPreceding, 0))
    # rows of the ticker between the last touched month and the first row of this one
    hit = at.withColumn("hit", F.col("touched") | F.coalesce(F.col("upto") - F.col("n") - last < rows, F.lit(False)))
    write = sorted(r[0] for r in hit.where("hit").select(m).distinct().collect())
    # a written month is written for all tickers: each one's rows from the end of a month to the next written one
    written = at.withColumn("hit", m.isin(write))
    following = F.min(F.when(F.col("hit"), F.col("upto") - F.col("n"))).over(series.rowsBetween(0, Window.unboundedFollowing))
    need = written.select(m, (F.col("hit") | F.coalesce(following - F.col("upto") < rows, F.lit(False))).alias("need"))
    return write, sorted(r[0] for r in need.where("need").select(m).distinct().collect())


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.year("trade_date") * 100 + F.month("trade_date"))


def write_months(df: DataFrame, path: str, months: list[int] | None, order=("ticker", "trade_date")) -> DataFrame:
    """Replace the given months (None: all that ``df`` has) of the table at ``path`` and return the table.

    Files of a month are range-partitioned and sorted by ``order``.
    """
    rows = with_month(df)
    if months is not None:
        rows = rows.where(F.col(MONTH).isin(months))
    if months is None or months:
        (tables.clustered(rows, (MONTH, *order)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path))
    spark = df.sparkSession
    return read_table(spark, path) if table_exists(spark, path) else spark.createDataFrame([], rows.schema)  # no row so far


def update_indicators(spark: SparkSession, silver_path: str, table_path: str, touched: list[int],
                      built_at=None) -> tuple[DataFrame, list[int]]:
    """Rewrite the affected months of the indicator table; returns the table and those months."""
    silver = read_table(spark, silver_path)
    write, read = affected_months(silver, touched)
    source = silver.where(F.col(PARTITION_COLUMN).isin(read)).drop(PARTITION_COLUMN)
    fresh = add_indicators(stage_prices(source), built_at=built_at)
    return write_months(fresh, table_path, write), write


def changed_rows(old: DataFrame, new: DataFrame, keys=("ticker", "trade_date")) -> tuple[DataFrame, DataFrame]:
    """(removed, added): rows of ``old`` that ``new`` lacks or has with other values, and the reverse.

    Both are unique by ``keys``; columns of ``new`` count, load stamps should be left out.
    """
    cols = new.columns
    row = F.struct(*cols)
    sides = old.select(*cols).select(*keys, row.alias("o"), F.lit(None).cast(row_type(new)).alias("n")) \
        .unionByName(new.select(*keys, F.lit(None).cast(row_type(new)).alias("o"), row.alias("n")))
    pairs = sides.groupBy(*keys).agg(F.first("o", ignorenulls=True).alias("o"), F.first("n", ignorenulls=True).alias("n")) \
        .where(~F.col("o").eqNullSafe(F.col("n")))
    return pairs.where("o is not null").select("o.*"), pairs.where("n is not null").select("n.*")


def row_type(df: DataFrame):
    """The struct type of a whole row, every field nullable."""
    from pyspark.sql.types import StructField, StructType
    return StructType([StructField(f.name, f.dataType) for f in df.schema])


def update_sector_states(spark: SparkSession, path: str, removed: DataFrame, added: DataFrame,
                         daily: DataFrame) -> tuple[DataFrame, list[int]]:
    """Bring the stored sector states at ``path`` up to date; returns the states' table and the months written.

    ``removed`` and ``added``: the daily rows that a revision took away and
    brought (a changed row is in both); ``daily``: all daily rows after it,
    with ``MONTH`` if it is partitioned by it. The months of these rows are the
    only ones read and written. Of ``daily`` only the groups are read whose
    best or worst return was taken away.
    """
    gone, new = tables.stage(spark, with_month(removed), "removed"), tables.stage(spark, with_month(added), "added")
    months = touched_partitions(gone.select(MONTH).unionByName(new.select(MONTH)), MONTH)
    if not months:
        return read_table(spark, path), months
    if table_exists(spark, path):
        old = read_table(spark, path).where(F.col(MONTH).isin(months)).drop(MONTH)
    else:
        old = marts.sector_states(new.limit(0))
    merged = tables.stage(spark, marts.merge_states(old, gone, new), "states")
    lost = merged.where("_lost").select(F.col("sector").alias("_sector"), F.col("trade_date").alias("_day"))
    rows = daily if MONTH in daily.columns else with_month(daily)
    again = rows.where(F.col(MONTH).isin(months)).join(
        lost, F.col("sector").eqNullSafe(F.col("_sector")) & (F.col("trade_date") == F.col("_day")), "left_semi")
    fresh = tables.stage(spark, merged.where("not _lost").drop("_lost").unionByName(marts.sector_states(again)), "fresh")
    table = write_months(fresh, path, months, marts.GROUP)
    for copy in (gone, new, merged, fresh):
        tables.discard(copy)
    return table, months
