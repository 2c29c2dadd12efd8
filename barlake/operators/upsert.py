"""Keyed upsert of a new silver batch into the current silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barlake.operators.flatten import KEY_COLUMNS, keep_latest


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Merge ``incoming`` into ``current``: per key the newest ingest wins, one row per key.

    Ordering is by ``ingested_at`` (then values), never by arrival, so an
    older pull landing after a newer one cannot displace it. Keys compare
    with NULL equal to NULL, and copies already in ``current`` collapse too.

    One keyed aggregation with partial aggregation on the map side, whatever
    the sizes. To leave untouched history unread, merge by partition
    (``sources.merge``).
    """
    keys = keys or KEY_COLUMNS
    both = current.unionByName(incoming.select(*current.columns))
    return keep_latest(both, keys).select(*current.columns)
