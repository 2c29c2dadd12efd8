"""Final select of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, IntegerType, ShortType


def report(df: DataFrame) -> DataFrame:
    """Decimals to double, small integers to bigint; nothing else changes."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
