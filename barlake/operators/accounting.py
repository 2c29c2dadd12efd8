"""A batch of documents with its rejects and its row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators import flatten as fl
from barlake.sources.tables import stage

#: Share of unparseable documents beyond which a run fails instead of going on without them; a caller may allow more.
MAX_REJECTED_SHARE = 0.0


class BronzeUnreadable(RuntimeError):
    """Documents were read, but none or too few of them could be parsed."""


def document_days(docs: DataFrame, processed_at, value_col: str = "value", carry: list[str] | None = None) -> DataFrame:
    """Every (document, day) once, good or rejected, and one row for each document without days, from one pass."""
    return fl.flatten_documents(docs, processed_at, value_col, carry, skipped_rows=True).days


def good_rows(days: DataFrame) -> DataFrame:
    return days.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(days: DataFrame) -> DataFrame:
    """What was refused, to be stored: documents and days with the reason."""
    return days.where(F.col("reject_reason").isNotNull() & (F.col("reject_reason") != "no_series")) \
        .select("ticker", "date_key", "reject_reason", "processed_at")


def accounting(days: DataFrame) -> DataFrame:
    """One row of counts over ``document_days``: documents, days, and rows before and after cleaning."""
    why = F.coalesce("reject_reason", F.lit(""))
    good, bad, none = why == "", why == "unparseable_document", why == "no_series"
    counts = days.agg(
        F.count_if((F.col("pos") == 0) | bad).alias("documents"),
        F.count_if(none).alias("skipped_documents"),
        F.count_if(bad).alias("rejected_documents"),
        F.count_if(good).alias("parsed_days"),
        F.count_if(~good & ~bad & ~none).alias("rejected_days"),
        F.count_if(good & ~fl.usable_row()).alias("dropped_rows"),
        F.count_if(good & fl.usable_row()).alias("clean_rows"))
    final = fl.quality_filter(good_rows(days)).groupBy(*fl.KEY_COLUMNS).agg(F.lit(1).alias("n")) \
        .agg(F.count("n").alias("final_rows"))
    return counts.join(final, F.lit(True))  # one row each


def account(docs: DataFrame, processed_at, value_col: str = "value") -> tuple[DataFrame, DataFrame, dict]:
    """(silver rows, rejects, counts) of a batch; the flattened days are staged once and read three times."""
    days = stage(docs.sparkSession, document_days(docs, processed_at, value_col), "days")
    silver = fl.to_silver(fl.keep_latest(fl.quality_filter(good_rows(days)).drop("date_key")))
    return silver, rejects(days), accounting(days).first().asDict()


def store_counts(spark: SparkSession, counts: dict, root: str, batch_id) -> None:
    """Keep the counts of a batch, one row each under ``root/batch_id=...``; a repeated batch replaces its own."""
    row = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))
    (row.withColumn("stored_at", F.current_timestamp()).withColumn("batch_id", F.lit(str(batch_id)))
     .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(root))


def require_parsed(counts: dict, share: float = MAX_REJECTED_SHARE) -> None:
    """Raise if documents were read but none parsed, or more than ``share`` of them were rejected."""
    read, bad = counts["documents"], counts["rejected_documents"]
    if read and (bad == read or bad > share * read):
        raise BronzeUnreadable(f"{bad} of {read} documents could not be parsed")
