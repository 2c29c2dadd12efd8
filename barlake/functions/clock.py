"""Clock parameters as timestamp columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp_literal(value: datetime | str | Column) -> Column:
    """A run-time parameter as a TIMESTAMP column, read as wall-clock time of the session zone.

    Naive ``datetime`` values are formatted and parsed by Spark, so they mean
    the same instant as dates cast in the session zone (PySpark's own literal
    conversion would use the Python process zone instead).
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(value))
