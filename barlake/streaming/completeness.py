"""A day's documents are processed when the day is complete, or overdue.

A stream of landed file names (not of their contents) keeps, for each ingest
day, which of the expected tickers have arrived. A day is released once: as
``complete`` with the last expected ticker's first file, or as ``overdue`` when
``wait`` has passed since its first file. Files that land behind that release
it again (``late``), since their documents must not be lost either. A released
day is read whole and merged by key, which a replayed batch may do again.

The state (arrivals by ticker, counts, a timer) lies in the checkpoint, so a
restart goes on where it was. Its size is the number of tickers of the days
that were seen.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.functions.clock import timestamp_literal
from barlake.operators import accounting
from barlake.sources import bronze, merge
from barlake.streaming.arrival import bronze_stream

RELEASE_SCHEMA = "day string, status string, expected int, arrived int, files int"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def day_gate(tickers: list[str], wait_seconds: int):
    """The stateful processor, with what its tasks need inside: workers take it by value."""
    from pyspark.sql import Row
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    wanted = frozenset(tickers)

    class DayGate(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.tickers = handle.getMapState("tickers", "ticker string", "files int")
            # expected tickers that have arrived, files, end of the wait (0: none set), status
            self.day = handle.getValueState("day", "arrived int, files int, deadline long, status string")

        def handleInputRows(self, key, rows, timerValues):
            arrived, files, deadline, status = self.day.get() if self.day.exists() else (0, 0, 0, "waiting")
            for row in rows:
                ticker, files = (row.ticker,), files + 1
                seen = self.tickers.getValue(ticker)[0] if self.tickers.containsKey(ticker) else 0
                arrived += not seen and row.ticker in wanted
                self.tickers.updateValue(ticker, (seen + 1,))
            before = status
            if before != "waiting":
                status = "late"
            elif arrived == len(wanted):
                status = "complete"
            if status == "waiting" and not deadline:
                deadline = timerValues.getCurrentProcessingTimeInMs() + 1000 * wait_seconds
                self.handle.registerTimer(deadline)
            if before == "waiting" and status == "complete" and deadline:
                self.handle.deleteTimer(deadline)
            self.day.update((arrived, files, deadline, status))
            if status != "waiting":
                yield Row(day=key[0], status=status, expected=len(wanted), arrived=arrived, files=files)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            arrived, files, deadline, status = self.day.get()
            if status == "waiting":
                self.day.update((arrived, files, deadline, "overdue"))
                yield Row(day=key[0], status="overdue", expected=len(wanted), arrived=arrived, files=files)

        def close(self):
            pass

    return DayGate()


def arrivals(stream: DataFrame) -> DataFrame:
    """(day, ticker) of every landed file, from its folder and its name."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)_\d{8}_\d{6}[^/]*$", 1)
    day = F.format_string("%04d-%02d-%02d", "year", "month", "day")
    return stream.select(day.alias("day"), F.upper(F.trim(F.url_decode(name))).alias("ticker"))


def releases(stream: DataFrame, tickers: list[str], wait_seconds: int) -> DataFrame:
    """One row for each release of a day."""
    return arrivals(stream).groupBy("day").transformWithState(
        day_gate([t.strip().upper() for t in tickers], wait_seconds), RELEASE_SCHEMA, "Append", "ProcessingTime")


def process_days(spark: SparkSession, bronze_root: str, silver_root: str, processed_at: datetime | None, rejects_root: str,
                 max_rejected_share: float):
    """The ``foreachBatch`` function: read each released day whole, store its rejects, merge it into silver."""
    def run(batch: DataFrame, batch_id: int) -> None:
        stamp = timestamp_literal(processed_at) if processed_at else F.current_timestamp()
        for day in sorted({r.day for r in batch.select("day").collect()}):  # a calendar-bounded list
            silver, rejects, counts = accounting.account(bronze.read_bronze(spark, bronze_root, day), stamp)
            (rejects.withColumn("processing_date", F.lit(day)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("processing_date").parquet(rejects_root))
            accounting.store_counts(spark, counts, f"{silver_root.rstrip('/')}_counts", day)
            accounting.require_parsed(counts, max_rejected_share)
            merge.merge_into(spark, silver_root, silver)
    return run


def start_complete_days(spark: SparkSession, bronze_root: str, silver_root: str, checkpoint: str, tickers: list[str],
                        wait_seconds: int = 600, processed_at: datetime | None = None, available_now: bool = True,
                        rejects_root: str | None = None, poll: str = "1 minute",
                        max_rejected_share: float = accounting.MAX_REJECTED_SHARE) -> StreamingQuery:
    """Start the job; ``available_now`` looks at what has landed, then stops (an overdue day waits for a later run)."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # timers and map state need it; the query keeps its own copy of the settings
    try:
        writer = (releases(bronze_stream(spark, bronze_root), tickers, wait_seconds).writeStream.outputMode("append")
                  .foreachBatch(process_days(spark, bronze_root, silver_root, processed_at,
                                             rejects_root or f"{silver_root.rstrip('/')}_rejects", max_rejected_share))
                  .option("checkpointLocation", checkpoint))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll)
        return writer.start()
    finally:
        spark.conf.set(PROVIDER, before)
