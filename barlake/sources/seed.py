"""Seed (dimension) inputs: CSV with header, or inline rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

SEED_SCHEMA = StructType([
    StructField("ticker", StringType(), False),
    StructField("company_name", StringType(), True),
    StructField("sector", StringType(), True),
    StructField("market_cap_category", StringType(), True),
])


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Load a seed CSV with a header row against the declared schema (no inference)."""
    return (spark.read.option("header", True).option("mode", "FAILFAST")
            .schema(SEED_SCHEMA).csv(path))


def seed_from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Seed as inline rows (the INSERT ... VALUES form)."""
    return spark.createDataFrame(rows, SEED_SCHEMA)
