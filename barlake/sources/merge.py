"""Keyed merge into a partitioned silver table, rewriting only touched partitions.

Silver is partitioned by ``trade_month`` (yyyyMM as an integer, so partition
discovery reads it back with the same type). A batch touches a
few months (a pull re-sends about 100 days), so the merge:

1. stages the batch in the session's checkpoint folder (lineage cut; the
   batch is read twice);
2. reads the batch's partition values (a small, calendar-bounded list) and
   filters the table on them: the scan is pruned to those partitions;
3. merges those rows with the batch, newest ingest winning per key, and
   stages the result (the plan must not write to the path it reads);
4. writes the staged rows back with dynamic partition overwrite, which
   replaces exactly the touched partitions at job commit;
5. deletes the staged copies.

Untouched history is neither read nor rewritten. Re-running a failed merge
gives the same result, because keeping the newest row per key is idempotent.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.flatten import KEY_COLUMNS, keep_latest
from barlake.sources.tables import clustered, discard, stage

PARTITION_COLUMN = "trade_month"


def with_partition(df: DataFrame, col: str = PARTITION_COLUMN) -> DataFrame:
    return df.withColumn(col, F.year("trade_date") * 100 + F.month("trade_date"))


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` holds committed Parquet data.

    Spark's file listing skips hidden and underscore entries (a running
    dynamic-overwrite write stages under ``.spark-staging-*``), and reading a
    path without data files raises. Any other error is passed on: taking it
    for "no table" would overwrite months without their history.
    """
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def touched_partitions(batch: DataFrame, col: str = PARTITION_COLUMN) -> list:
    """Partition values present in a batch.

    A list of partition values (months), not data: bounded by the calendar
    span of the batch, and needed as a literal filter so the table scan is
    pruned statically to those partitions.
    """
    return sorted(r[0] for r in batch.select(col).distinct().collect())


def merge_into(spark: SparkSession, path: str, incoming: DataFrame,
               keys: list[str] | None = None, col: str = PARTITION_COLUMN) -> DataFrame:
    """Merge ``incoming`` silver rows into the partitioned table at ``path``.

    Returns the table as read back after the merge.
    """
    keys = keys or KEY_COLUMNS
    batch = stage(spark, with_partition(incoming, col), "batch")
    months = touched_partitions(batch, col)
    exists = table_exists(spark, path)
    if not months:  # T14: nothing to merge, the table is left as it is
        return spark.read.parquet(path) if exists else batch
    if exists:
        current = spark.read.parquet(path)
        current_touched = current.where(F.col(col).isin(months))
        merged = keep_latest(current_touched.unionByName(batch.select(*current.columns)),
                             keys + [col]).select(*current.columns)
        staged = stage(spark, merged, "merged")  # the plan reads the path it will write
        copies = [batch, staged]
    else:
        staged = keep_latest(batch, keys + [col]).select(*batch.columns)
        copies = [batch]
    # Range partitioning by (month, ticker, date): a big month is spread over
    # many tasks (boundaries are sampled), each writing sorted files.
    (clustered(staged, (col, "ticker", "trade_date")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(col).parquet(path))
    for copy in copies:  # committed: the staged copies are not read again
        discard(copy)
    return spark.read.parquet(path)
