"""How task code reaches the executors, and where stages are kept."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from barlake.session import ensure_checkpoint_dir
from barlake.sources import tables

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def task(module: str, name: str, **params):
    """A ``mapInArrow``/``applyInArrow`` function that imports ``module.name`` in the worker.

    The worker imports the module itself (rather than unpickling it), so
    module-level caches live as long as the worker. On a cluster the package
    is installed; in local mode the source folder is put on the path.
    """
    root = _ROOT

    def run(data):
        import importlib
        import sys
        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(data, **params)

    return run


def new_folder(spark: SparkSession, tag: str) -> str:
    """A fresh path in the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage.

    A lost executor loses none of it. The job's shuffle files go when the
    write is done, as nothing reads them again. The folder lives until
    ``drop``, else as long as the session's checkpoint folder.
    """
    spark = df.sparkSession
    path = new_folder(spark, tag)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop(*kept: DataFrame) -> None:
    """Delete what ``keep`` wrote, once nothing will read it again."""
    for df in kept:
        tables.discard(df)


def tasks_for(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the launcher sets them to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
