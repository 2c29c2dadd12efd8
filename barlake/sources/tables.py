"""Files, tables and layout: silver writes, catalog DDL, reloads, materialisation."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlake.operators import quality, staging
from barlake.operators.flatten import KEY_COLUMNS, SILVER_SCHEMA

# Fixed values of the strict landing table: key, maximum lengths and required columns.
LANDING_SCHEMA = SILVER_SCHEMA
LANDING_KEY = KEY_COLUMNS
LANDING_MAX_LENGTH = {"ticker": 10, "source": 50}
LANDING_REQUIRED = ["ticker", "trade_date"]


def stage(spark: SparkSession, df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the session's checkpoint folder and read it back.

    Cuts the lineage in one pass (a reliable ``checkpoint()`` computes the
    plan twice unless it is cached first); the copy lives in the shared
    folder the cluster names in ``spark.checkpoint.dir``, so losing an
    executor later does not recompute the stage.
    """
    import uuid

    from barlake.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def discard(staged: DataFrame) -> None:
    """Delete the copy that ``stage`` made, once nothing will read it again.

    Storage that pyarrow cannot reach by URI keeps the copy, as long as the
    checkpoint folder lives.
    """
    import pyarrow as pa
    from pyarrow import fs
    files = staged.inputFiles()
    if not files:
        return
    try:
        store, path = fs.FileSystem.from_uri(files[0].rsplit("/", 1)[0])
    except (pa.ArrowInvalid, OSError):
        return
    store.delete_dir(path)


def clustered(df: DataFrame, cluster_cols=("ticker", "trade_date")) -> DataFrame:
    """Range-partition and sort by (ticker, trade_date) before a write.

    Range partitioning splits even a very large ticker over several tasks by
    date (boundaries are sampled), and sorted files give Parquet row-group
    min/max statistics that let a "one ticker, date range" scan skip most
    row groups.
    """
    cols = list(cluster_cols)
    return df.repartitionByRange(*cols).sortWithinPartitions(*cols)


def write_silver(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 mode: str = "overwrite") -> None:
    """Write silver Parquet, clustered, optionally partitioned.

    With ``partition_by`` an overwrite replaces only the partitions present
    in ``df``, whatever the session's overwrite mode. For very many tickers
    partition by a coarse column (e.g. a year) instead of ticker.
    """
    writer = clustered(df).write.mode(mode)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, name: str, buckets: int, by=("ticker",), order=("ticker", "trade_date"),
                   path: str | None = None) -> DataFrame:
    """Write ``df`` as a catalog table hashed into ``buckets`` by ``by`` and sorted by ``order``; returns the table.

    For very many tickers, where a folder each would be too many: tables with
    the same ``by`` and ``buckets`` join, and windows by ``by`` run, without a
    shuffle. The rows are dealt by the buckets' own hash first, so a bucket is
    one sorted file. Write the staged prices: staging works the ticker out anew,
    and what was bucketed by the raw one is shuffled. A bucket holds whole keys: choose ``buckets`` so that one
    fits a task; a ticker has at most a row a calendar day. The table of that
    name is replaced.
    """
    columns = [c for c in order if c in df.columns]
    writer = df.repartition(buckets, *by).write.format("parquet").mode("overwrite").bucketBy(buckets, *by).sortBy(*columns)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def create_schemas(spark: SparkSession, names=("raw", "analytics")) -> None:
    """S12."""
    for n in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {n}")


def _ddl_columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _place(path: str) -> str:
    """A location in one form: local paths absolute and without their scheme."""
    if "://" not in path and not path.startswith(("/", "file:")):
        path = os.path.abspath(path)
    return re.sub("^file:/+", "/", path).rstrip("/")


def create_external_table(spark: SparkSession, name: str, path: str, schema: StructType,
                          partition_by: list[str] | None = None) -> None:
    """Declare a Parquet table over existing files (partition columns last).

    A relative path is taken from the working folder, where the files were
    written, not from the warehouse folder.
    """
    if "://" not in path and not path.startswith(("/", "file:")):
        path = os.path.abspath(path)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    fields = [f for f in schema.fields if f.name not in (partition_by or [])]
    fields += [f for f in schema.fields if f.name in (partition_by or [])]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl_columns(StructType(fields))}) "
              f"USING parquet{part} LOCATION '{path}'")


def repair_table(spark: SparkSession, name: str) -> None:
    """Register the partitions found on storage."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def conform(df: DataFrame, schema: StructType = LANDING_SCHEMA) -> DataFrame:
    """Select and cast to the declared landing schema (extra columns dropped)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def landing_violations(df: DataFrame) -> DataFrame:
    """S13 checks Parquet cannot enforce: required columns, lengths, key.

    Returns (check, detail, n) rows; empty when the data fits the table.
    """
    nulls = (quality.null_counts(df, LANDING_REQUIRED, "landing")
             .where(F.col("null_count") > 0)
             .select(F.lit("not_null").alias("check"), F.col("column_name").alias("detail"),
                     F.col("null_count").alias("n")))
    too_long = df.agg(*[F.count_if(F.length(c) > n).alias(c)
                        for c, n in LANDING_MAX_LENGTH.items()])
    lengths = (too_long.unpivot([], list(LANDING_MAX_LENGTH), "detail", "n")
               .where(F.col("n") > 0).select(F.lit("max_length").alias("check"), "detail", "n"))
    dups = (quality.duplicate_keys(df, LANDING_KEY)
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 0)
            .select(F.lit("unique_key").alias("check"), F.lit(",".join(LANDING_KEY)).alias("detail"),
                    "n"))
    return nulls.unionByName(lengths).unionByName(dups)


def landing_rule() -> Column:
    """The rule of the strict table that a row breaks by itself, NULL if none."""
    rules = [F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")) for c in LANDING_REQUIRED]
    rules += [F.when(F.length(c) > n, F.lit(f"max_length:{c}")) for c, n in LANDING_MAX_LENGTH.items()]
    return F.coalesce(*rules)


def audited(df: DataFrame) -> DataFrame:
    """Rows of the landing schema with ``rule``: what the strict table would refuse them for, NULL if nothing.

    Of rows that share a key the newest stays, and the others break the key.
    """
    ruled = conform(df).withColumn("rule", landing_rule())
    others = [c for c in df.columns if c in LANDING_SCHEMA.names and c not in (*LANDING_KEY, "ingested_at")]
    newest = Window.partitionBy(*LANDING_KEY).orderBy(F.col("rule").isNotNull(), F.desc_nulls_last("ingested_at"), *others)
    again = F.when(F.col("rule").isNull() & (F.row_number().over(newest) > 1), F.lit("unique_key:" + ",".join(LANDING_KEY)))
    return ruled.withColumn("rule", F.coalesce("rule", again))


class BatchRefused(RuntimeError):
    """More of a batch breaks the landing rules than may: nothing of it was published."""


def write_audit(spark: SparkSession, batch: DataFrame, quarantine: str, batch_id: str, max_refused_share: float = 1.0) -> DataFrame:
    """S13 write and audit: the rows of a batch that may be published.

    The batch is staged; rows that break a rule are stored under
    ``quarantine/batch_id=...`` with the rule (a repeated batch replaces its
    own). If they are more than ``max_refused_share`` of all, the batch is
    refused before anything of it reaches the table.
    """
    rows = stage(spark, audited(batch), "audit")
    (rows.where(F.col("rule").isNotNull()).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(quarantine))
    n = rows.agg(F.count("*").alias("rows"), F.count("rule").alias("refused")).first()
    if n.refused > max_refused_share * n.rows:
        raise BatchRefused(f"{n.refused} of {n.rows} rows break the landing rules")
    return rows.where(F.col("rule").isNull()).drop("rule")


def publish(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None) -> str:
    """Make ``df`` the content of ``name`` in one statement; returns the new version's table.

    The rows are written aside, as a table of their own, and ``name`` is a view
    of it: replacing the view is the switch. A reader that began before sees
    the old rows to its end, one that begins after the new ones, and nobody
    none. Of the versions before, the last one stays for its readers and older
    ones go. ``path`` names a folder for the versions (the warehouse if None).
    A plain table of that name becomes a version: the one time that the name
    is gone for a moment.
    """
    import uuid
    spark = df.sparkSession
    schema, _, short = name.rpartition(".")
    catalog = [t for t in spark.catalog.listTables(schema or None) if not t.isTemporary]
    mark = f"{short.lower()}__v"
    before = sorted(t.name for t in catalog if t.name.startswith(mark))
    version = f"{mark}{len(before) and int(before[-1][len(mark):len(mark) + 8]) + 1:08d}_{uuid.uuid4().hex[:8]}"
    full = f"{schema}.{version}" if schema else version
    writer = df.write
    if path is not None:
        writer = writer.option("path", f"{path.rstrip('/')}/{version}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(full)
    if any(t.name == short.lower() and t.tableType != "VIEW" for t in catalog):
        old = f"{mark}00000000_plain"
        if old in before:  # the plain table of an earlier time
            spark.sql(f"DROP TABLE {f'{schema}.{old}' if schema else old}")
        spark.sql(f"ALTER TABLE {name} RENAME TO {f'{schema}.{old}' if schema else old}")
        before = [b for b in before if b != old] + [old]  # it held the rows last
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {full}")
    for old in before[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {f'{schema}.{old}' if schema else old}")
    return full


def reload_table(spark: SparkSession, table: str, parquet_path: str, path: str | None = None,
                 partition_by: list[str] | None = None) -> str:
    """The whole content of a table from Parquet files, without a moment in which it is empty (``publish``).

    Columns and their order are those that the table has; everything that was
    in it goes, partitions that the files lack included.
    """
    columns = spark.table(table).columns
    return publish(spark.read.parquet(parquet_path).select(*columns), table, path, partition_by)


def materialise_table(df: DataFrame, name: str) -> str:
    """Create-table-as-select, replacing any previous content at once (``publish``)."""
    return publish(df, name)


def materialise_view(df: DataFrame, name: str) -> None:
    """A (session) view: nothing is stored, the plan runs when queried."""
    df.createOrReplaceTempView(name)


def create_staging_view(spark: SparkSession, name: str, raw_table: str) -> None:
    """The staging view in the catalog, over the landing table; it outlives the session's run."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {staging.staging_view(raw_table)}")


def register_partitions(spark: SparkSession, name: str, path: str, schema: StructType, column: str, values: list | None) -> None:
    """Declare the table if it is not there, and register the partitions that a write touched.

    A known table is not dropped: one statement adds the given partitions,
    so the cost does not grow with history. A table that is new, lies
    elsewhere (as do the versions behind a name that ``publish`` made a view; they stay) or has other
    columns now, is declared and repaired over all its files; ``values`` of None repair it too.
    """
    known = spark.catalog.tableExists(name)
    if known:
        where = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        columns = {(f.name, f.dataType) for f in spark.table(name).schema}
        if where.get("Type") == "VIEW":
            spark.sql(f"DROP VIEW {name}")
            known = False
        elif _place(where["Location"]) != _place(path) or columns != {(f.name, f.dataType) for f in schema}:
            spark.sql(f"DROP TABLE {name}")  # external: the files stay
            known = False
    create_external_table(spark, name, path, schema, [column] if column else None)
    if column and known and values is not None:
        if values:
            parts = " ".join(f"PARTITION ({column}={int(v)})" for v in values)
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    elif column:
        repair_table(spark, name)
    if known:
        spark.catalog.refreshTable(name)
