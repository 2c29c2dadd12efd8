"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Equi-join a fact to a dimension, without a hint.

    The planner broadcasts the dimension only when its estimated size is
    below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise plans a
    sort-merge join; AQE re-checks the real size at runtime.
    """
    return fact.join(dim, on, how)
