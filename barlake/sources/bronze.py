"""Bronze landing: payload triage, metadata envelope, partitioned landing, readers.

Landing writes one document a file, named after its ticker and ingest time,
under Hive-style ``year=/month=/day=`` folders of the ingest date. Reading takes
whole files, however a document is printed; a file of several documents (JSON
Lines, say) gives them all, as ``operators.flatten`` takes texts apart.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.functions.json import is_one_object
from barlake.sources import landing

# Fixed values of the envelope.
ENVELOPE_SOURCE = "alpha_vantage"
ENVELOPE_API_FUNCTION = "TIME_SERIES_DAILY"
ENVELOPE_PIPELINE = "barlake"

# Keys of an API payload that mark an error instead of data.
ERROR_KEY = "Error Message"
NOTE_KEY = "Note"

PARTITION_COLUMNS = ["year", "month", "day"]


class Triage(NamedTuple):
    accepted: DataFrame
    quarantined: DataFrame


def triage_payloads(payloads: DataFrame, payload_col: str = "payload") -> Triage:
    """Split API payloads into data and quarantine (with the reason).

    A payload with an ``Error Message`` key is quarantined as
    ``error_message``, one with a ``Note`` key (rate limit) as
    ``rate_limited``, whatever the key's value; what is not one JSON object
    and nothing else (a NULL, a web page, a list, text behind the object) as
    ``not_json``.
    """
    keys = F.json_object_keys(F.when(is_one_object(F.col(payload_col)), F.col(payload_col)))
    reason = (F.when(keys.isNull(), F.lit("not_json"))
              .when(F.array_contains(keys, ERROR_KEY), F.lit("error_message"))
              .when(F.array_contains(keys, NOTE_KEY), F.lit("rate_limited")))
    tagged = payloads.withColumn("quarantine_reason", reason)
    return Triage(
        tagged.where(F.col("quarantine_reason").isNull()).drop("quarantine_reason"),
        tagged.where(F.col("quarantine_reason").isNotNull()).drop(payload_col),
    )


def store_quarantine(quarantined: DataFrame, root: str, fetched_at: Column) -> None:
    """Keep what triage refused, by ingest date; storing a date's rows again replaces them."""
    (quarantined.withColumn("ingest_date", F.to_date(fetched_at)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date").parquet(root))


def iso_timestamp(ts: Column) -> Column:
    """ISO-8601 text with microseconds and a numeric offset (+00:00 in UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def envelope(accepted: DataFrame, ticker: Column, fetched_at: Column,
             payload_col: str = "payload") -> DataFrame:
    """S3: wrap each payload in a metadata envelope; adds ``value`` and landing columns.

    The payload is serialised to one line, so that a document printed over
    several lines stays one document. Landing columns:
    ``year``, ``month``, ``day`` of the ingest time and a file stem
    ``TICKER_yyyyMMdd_HHmmss``.
    """
    meta = F.to_json(F.struct(
        ticker.alias("ticker"),
        F.lit(ENVELOPE_SOURCE).alias("source"),
        F.lit(ENVELOPE_API_FUNCTION).alias("api_function"),
        iso_timestamp(fetched_at).alias("ingestion_timestamp"),
        F.lit(ENVELOPE_PIPELINE).alias("pipeline"),
    ))
    value = F.concat(F.lit('{"metadata": '), meta, F.lit(', "raw_data": '),
                     F.regexp_replace(F.col(payload_col), r"[\r\n]+\s*", " "), F.lit("}"))
    return accepted.select(
        "*",
        value.alias("value"),
        F.date_format(fetched_at, "yyyy").alias("year"),
        F.date_format(fetched_at, "MM").alias("month"),
        F.date_format(fetched_at, "dd").alias("day"),
        F.concat(F.upper(F.trim(ticker)), F.lit("_"),
                 F.date_format(fetched_at, "yyyyMMdd_HHmmss")).alias("file_stem"),
    )


def file_name() -> Column:
    """``TICKER_yyyyMMdd_HHmmss.json`` from ``file_stem``: no path separators, and nothing that listings hide."""
    stem = F.url_encode(F.coalesce("file_stem", F.lit("UNKNOWN")))
    hidden = F.concat(F.when(stem.startswith("_"), F.lit("%5F")).otherwise(F.lit("%2E")), stem.substr(2, 1 << 20))
    return F.when(stem.rlike("^[._]"), hidden).otherwise(stem)


def land_documents(docs: DataFrame, root: str) -> None:
    """Land each document as a file of its own under its ingest date, by its name.

    Documents of one name (one ticker, one second) are numbered from the
    second on, so none replaces another; landing the same documents again
    replaces the same files. An empty document is landed as a line end, as
    Spark does not read empty files.
    """
    same = Window.partitionBy(*PARTITION_COLUMNS, "stem").orderBy("value")
    named = docs.select(F.when(F.length("value") > 0, F.col("value")).otherwise(F.lit("\n")).alias("value"),
                        file_name().alias("stem"), *PARTITION_COLUMNS).withColumn("n", F.row_number().over(same))
    number = F.when(F.col("n") > 1, F.concat(F.lit("_"), F.col("n").cast("string"))).otherwise(F.lit(""))
    landing.land(named.select("value", F.concat("stem", number, F.lit(".json")).alias("file_name"), *PARTITION_COLUMNS), root)


def read_bronze(spark: SparkSession, root: str, processing_date: str | None = None) -> DataFrame:
    """Scan landed files, one row each, optionally of one processing date only.

    One date lists and reads its own folder only (``basePath`` keeps the
    partition columns), so the cost does not grow with history; a date
    without a folder is an empty result.
    """
    reader = spark.read.option("basePath", root)
    schema = "value string, year int, month int, day int"
    path = root
    if processing_date is not None:
        d = date.fromisoformat(processing_date)
        path = f"{root.rstrip('/')}/year={d:%Y}/month={d:%m}/day={d:%d}"
    try:
        df = reader.text(path, wholetext=True)
    except AnalysisException as e:
        if processing_date is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema).withColumn("source_file", F.lit(""))
    return df.withColumn("source_file", F.col("_metadata.file_path"))
