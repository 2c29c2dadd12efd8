"""Process bronze documents as they land, merging each batch into silver.

A file-source stream over the bronze root (``year=/month=/day=`` folders are
discovered as columns) with a checkpoint, so every file is taken exactly
once. Each micro-batch is flattened, cleaned and deduplicated, then merged
into silver by key; only the months the batch touches are read and rewritten.
Merging is idempotent (newest ingest per key), so re-running a failed batch
after a restart gives the same silver. What a batch rejects, and its counts,
are stored under its batch id (a replayed batch replaces its own rows), and a batch of which
no document parses stops the stream instead of being lost.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.functions.clock import timestamp_literal
from barlake.operators import accounting
from barlake.sources import merge

BRONZE_STREAM_SCHEMA = "value string, year int, month int, day int"


def bronze_stream(spark: SparkSession, bronze_root: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BRONZE_STREAM_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(bronze_root, wholetext=True)


def merge_batch(spark: SparkSession, silver_root: str, processed_at: datetime | None = None,
                rejects_root: str | None = None, max_rejected_share: float = accounting.MAX_REJECTED_SHARE):
    """The ``foreachBatch`` function: flatten the batch, store its rejects, merge it into silver."""
    rejects_root = rejects_root or f"{silver_root.rstrip('/')}_rejects"

    def run(batch: DataFrame, batch_id: int) -> None:
        stamp = timestamp_literal(processed_at) if processed_at else F.current_timestamp()
        silver, rejects, counts = accounting.account(batch, stamp)
        (rejects.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(rejects_root))
        accounting.store_counts(spark, counts, f"{silver_root.rstrip('/')}_counts", batch_id)
        accounting.require_parsed(counts, max_rejected_share)
        merge.merge_into(spark, silver_root, silver)
    return run


def start_arrival(spark: SparkSession, bronze_root: str, silver_root: str, checkpoint: str,
                  processed_at: datetime | None = None,
                  available_now: bool = True, rejects_root: str | None = None,
                  max_rejected_share: float = accounting.MAX_REJECTED_SHARE) -> StreamingQuery:
    """Start the arrival job; ``available_now`` processes what has landed, then stops."""
    writer = (bronze_stream(spark, bronze_root).writeStream
              .foreachBatch(merge_batch(spark, silver_root, processed_at, rejects_root, max_rejected_share))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
