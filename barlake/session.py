"""Session helpers.

The library never sets cluster-wide options behind the caller's back; these
helpers are for tests, the bench and the command-line pipeline.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "barlake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume.

    * UTC session zone, so timestamps and dates agree with the SQL oracle.
    * ANSI mode stays on (Spark 4 default); operators use ``try_*`` functions.
    * AQE on: runtime coalescing of shuffle partitions and skew-join splits.
    * No Spark UI.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Small but CPU-heavy shuffles (per-ticker windows over daily bars)
        # keep some parallelism instead of being coalesced into one task;
        # large shuffles are still sized by the advisory partition size.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # size check behind every unhinted broadcast join (estimated bytes)
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is kept
    as is. Only when nothing is configured (local tests) a scratch folder is
    created.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current and hasattr(spark.sparkContext, "getCheckpointDir"):
        current = spark.sparkContext.getCheckpointDir()
    if current:
        if hasattr(spark.sparkContext, "getCheckpointDir") and not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="barlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
