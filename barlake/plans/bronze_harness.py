"""Bronze documents derived from the daily bars, with faults chosen by arithmetic.

Each ticker is "pulled" once a month: pull ``q`` (a month index,
year * 12 + month - 1) carries the bars of months q-2..q, newest first, and
is ingested on the first day of month q+1 at 18:00 UTC. A day therefore
arrives in three pulls (revision r = q - month index of the day, 0..2);
earlier revisions carry prices (2 - r) cents and volume (2 - r) higher, so
the newest pull is the one that must win.

Faults are picked from the day of year, the revision and the pull index (no
hash), so the SQL oracle can repeat them:

======================  =====================================================
day fault (first rule)  r = 2 and doy % 17 = 0: close "abc"
                        r = 2 and doy % 31 = 0: high is JSON null
                        r = 1 and doy % 37 = 0: the day is a string
                        r = 2 and doy % 41 = 0: volume "N.0"
                        r = 2 and doy % 43 = 0: low "nan"
                        r = 2 and doy % 29 = 0: open key missing (price 0)
                        doy % 13 = 0: volume key missing (volume 0)
pull (first rule)       q % 13 = 7: "Error Message" payload (quarantined)
                        q % 23 = 9: "Note" payload (quarantined)
                        q % 29 = 11: a web page instead of JSON (quarantined)
                        q % 11 in (5, 8, 10): file damaged ({bad, [1], empty)
                        q % 19 = 0: empty series (skipped)
extra                   q % 5 = 0: an extra day keyed YYYY-13-40
                        q % 3 = 1: ticker written lower case with blanks
======================  =====================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from barlake.operators import flatten as fl
from barlake.sources import bronze
from barlake.sources.testbars import bars_for

PROCESSED_AT = "2001-12-01 06:00:00"
# Pulls up to this month index land in the first batch of the upsert test
# (except every fourth, which arrives late, with the second batch).
UPSERT_SPLIT_MONTH = 1998 * 12


def _q(col: str = "q") -> Column:
    return F.col(col)


def _text(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def pull_days(bars: DataFrame) -> DataFrame:
    """Every bar once per pull that carries it, with its revision and fault."""
    m = F.year("trade_date") * 12 + F.month("trade_date") - 1
    doy = F.dayofyear("trade_date")
    r = F.col("r")
    fault = (F.when((r == 2) & (doy % 17 == 0), "abc_close")
             .when((r == 2) & (doy % 31 == 0), "null_high")
             .when((r == 1) & (doy % 37 == 0), "not_object")
             .when((r == 2) & (doy % 41 == 0), "decimal_volume")
             .when((r == 2) & (doy % 43 == 0), "nan_low")
             .when((r == 2) & (doy % 29 == 0), "missing_open")
             .when(doy % 13 == 0, "missing_volume")
             .otherwise("none"))
    bump = ((F.lit(2) - r).cast(DecimalType(12, 2)) / 100).cast(DecimalType(12, 2))
    return (bars.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("r"))
            .select("ticker", "trade_date", "r", (m + r).alias("q"), fault.alias("fault"),
                    *[(F.col(c) + bump).cast(DecimalType(12, 2)).alias(c)
                      for c in ("open_price", "high_price", "low_price", "close_price")],
                    (F.col("volume") + (F.lit(2) - r)).alias("volume")))


def day_entry(days: DataFrame) -> Column:
    """JSON text of one series entry, faults applied."""
    f = F.col("fault")
    s = lambda c: F.col(c).cast("string")
    open_ = F.when(f == "missing_open", F.lit("")).otherwise(
        F.concat(F.lit('"1. open": '), _text(s("open_price")), F.lit(", ")))
    high = F.when(f == "null_high", F.lit("null")).otherwise(_text(s("high_price")))
    low = F.when(f == "nan_low", F.lit('"nan"')).otherwise(_text(s("low_price")))
    close = F.when(f == "abc_close", F.lit('"abc"')).otherwise(_text(s("close_price")))
    vol = (F.when(f == "missing_volume", F.lit(""))
           .when(f == "decimal_volume",
                 F.concat(F.lit(', "5. volume": '), _text(F.concat(s("volume"), F.lit(".0")))))
           .otherwise(F.concat(F.lit(', "5. volume": '), _text(s("volume")))))
    obj = F.concat(F.lit("{"), open_, F.lit('"2. high": '), high, F.lit(', "3. low": '), low,
                   F.lit(', "4. close": '), close, vol, F.lit("}"))
    body = F.when(f == "not_object", F.lit('"oops"')).otherwise(obj)
    return F.concat(_text(F.col("trade_date").cast("string")), F.lit(": "), body)


def fetched_at(q: Column) -> Column:
    nxt = q + 1
    return F.make_timestamp((nxt / 12).cast("int"), nxt % 12 + 1, F.lit(1), F.lit(18),
                            F.lit(0), F.lit(0).cast("decimal(8,6)"))


def api_payloads(bars: DataFrame) -> DataFrame:
    """One API payload per (ticker, pull): ticker, q, fetched_at, payload."""
    days = pull_days(bars)
    # Each entry starts with its quoted ISO date, so sorting the texts sorts
    # by date (newest first, as the API lists them).
    entries = (days.groupBy("ticker", "q")
               .agg(F.sort_array(F.collect_list(day_entry(days)), asc=False).alias("es")))
    # One pull holds at most three months of days, so each list is bounded.
    series = F.array_join("es", ", ")
    # The layout of a daily-series API payload and its error bodies.
    extra = F.when(_q() % 5 == 0, F.concat(
        F.lit(', "'), F.lpad((_q() / 12).cast("int").cast("string"), 4, "0"),
        F.lit('-13-40": {"1. open": "1.00", "2. high": "1.00", "3. low": "1.00", '
              '"4. close": "1.00", "5. volume": "100"}'))).otherwise(F.lit(""))
    series_obj = F.when(_q() % 19 == 0, F.lit("{}")).otherwise(
        F.concat(F.lit("{"), series, extra, F.lit("}")))
    data = F.concat(F.lit('{"Meta Data": {"1. Information": "Daily Prices", "2. Symbol": '),
                    _text(F.col("ticker")), F.lit('}, "' + fl.SERIES_KEY + '": '), series_obj,
                    F.lit("}"))
    payload = (F.when(_q() % 13 == 7, F.lit('{"Error Message": "Invalid API call."}'))
               .when(_q() % 23 == 9, F.lit('{"Note": "API call frequency exceeded."}'))
               .when(_q() % 29 == 11, F.lit("<html>busy</html>"))
               .otherwise(data))
    return entries.select("ticker", "q", fetched_at(_q()).alias("fetched_at"),
                          payload.alias("payload"))


def landed_documents(payloads: DataFrame) -> DataFrame:
    """Accepted payloads in their envelope; some files damaged on the way."""
    accepted = bronze.triage_payloads(payloads).accepted
    shown = F.when(_q() % 3 == 1, F.concat(F.lit(" "), F.lower("ticker"), F.lit(" "))) \
        .otherwise(F.col("ticker"))
    docs = bronze.envelope(accepted, shown, F.col("fetched_at"))
    damaged = (F.when(_q() % 11 == 5, F.lit("{bad"))
               .when(_q() % 11 == 8, F.lit("[1]"))
               .when(_q() % 11 == 10, F.lit(""))
               .otherwise(F.col("value")))
    return docs.withColumn("value", damaged)


def documents_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_documents(api_payloads(bars_for(spark, sf_dir)))


def flattened(spark, sf_dir) -> fl.Flattened:
    return fl.flatten_documents(documents_for(spark, sf_dir), PROCESSED_AT, carry=["q"])


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"))


ROW_COLUMNS = ["ticker", "trade_date", "open_price", "high_price", "low_price", "close_price",
               "volume", "source", "ingested_at"]


def q_payload_triage(spark, sf_dir):
    quarantined = bronze.triage_payloads(api_payloads(bars_for(spark, sf_dir))).quarantined
    return quarantined.select(
        "ticker", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"),
        "quarantine_reason")


def q_bronze_roundtrip(spark, sf_dir):
    rows = flattened(spark, sf_dir).rows
    return _stamp(rows.select("date_key", *ROW_COLUMNS))


def q_bronze_rejects(spark, sf_dir):
    rejects = flattened(spark, sf_dir).rejects
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def clean_rows(spark, sf_dir):
    return fl.quality_filter(flattened(spark, sf_dir).rows)


def q_silver_clean(spark, sf_dir):
    return _stamp(clean_rows(spark, sf_dir).select(*ROW_COLUMNS))


def silver_rows(rows: DataFrame) -> DataFrame:
    return fl.to_silver(fl.keep_latest(fl.quality_filter(rows).drop("date_key", "q")))


def q_silver_dedupe(spark, sf_dir):
    return _stamp(silver_rows(flattened(spark, sf_dir).rows).select(*ROW_COLUMNS))


def q_silver_upsert(spark, sf_dir):
    """Two batches merged by key; late pulls of the first period arrive with the second."""
    from barlake.operators.upsert import upsert
    from barlake.sources.tables import stage
    # Both batches read the same flattened rows: staged once.
    rows = stage(spark, flattened(spark, sf_dir).rows, "flattened")
    first = (_q() <= UPSERT_SPLIT_MONTH) & (_q() % 4 != 0)
    current = silver_rows(rows.where(first))
    incoming = silver_rows(rows.where(~first))
    return _stamp(upsert(current, incoming).select(*ROW_COLUMNS))


def q_silver_merge(spark, sf_dir):
    """The two batches of the upsert case merged into a month-partitioned table.

    Writes a fresh table under the session's checkpoint folder (the merge
    itself is the operator under test) and returns its rows.
    """
    import uuid

    from barlake.session import ensure_checkpoint_dir
    from barlake.sources.merge import merge_into
    from barlake.sources.tables import stage
    root = ensure_checkpoint_dir(spark).rstrip("/")
    rows = stage(spark, flattened(spark, sf_dir).rows, "flattened")
    first = (_q() <= UPSERT_SPLIT_MONTH) & (_q() % 4 != 0)
    path = f"{root}/silver-merge-{uuid.uuid4().hex}"
    merge_into(spark, path, silver_rows(rows.where(first)))
    out = merge_into(spark, path, silver_rows(rows.where(~first)))
    return _stamp(out.select(*ROW_COLUMNS))


def _fresh_path(spark, name):
    import uuid

    from barlake.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_silver_by_ticker(spark, sf_dir):
    """Silver partitioned by ticker; a second write of some tickers leaves the others alone."""
    from barlake.sources.tables import stage, write_silver
    rows = stage(spark, silver_rows(flattened(spark, sf_dir).rows), "silver")
    path = _fresh_path(spark, "silver-by-ticker")
    write_silver(rows, path, ["ticker"])
    write_silver(rows.where(F.length("ticker") % 2 == 0), path, ["ticker"])
    return _stamp(spark.read.parquet(path).select(*ROW_COLUMNS))


def q_table_reload(spark, sf_dir):
    """A partitioned catalog table holding a stale ticker, reloaded in full from Parquet; its readers see old or new rows."""
    from barlake.sources import tables
    rows = silver_rows(flattened(spark, sf_dir).rows)
    source, path = _fresh_path(spark, "reload-source"), _fresh_path(spark, "reload-table")
    tables.write_silver(rows, source)
    name = "reload_" + path.rsplit("-", 1)[1]
    silver = spark.read.parquet(source)
    tables.create_external_table(spark, name, path, silver.schema, ["ticker"])
    stale = silver.limit(1).withColumn("ticker", F.lit("STALE"))
    stale.select(*spark.table(name).columns).write.insertInto(name)
    tables.reload_table(spark, name, source, f"{path}-versions", ["ticker"])
    return _stamp(spark.table(name).select(*ROW_COLUMNS))


def q_landing_quarantine(spark, sf_dir):
    """A batch with rows that the strict table refuses: what is published, and what is stored with its rule."""
    from barlake.sources import tables
    rows = silver_rows(flattened(spark, sf_dir).rows)
    day = F.dayofyear("trade_date")
    broken = rows.withColumn("source", F.when(day % 23 == 0, F.repeat(F.lit("s"), 51)).otherwise(F.col("source"))) \
        .withColumn("ticker", F.when(day % 17 == 0, F.concat("ticker", F.lit("_TOO_LONG"))).when(day % 31 == 0, F.lit(None)).otherwise(F.col("ticker")))
    older = broken.where(day % 29 == 0).withColumn("ingested_at", F.col("ingested_at") - F.expr("INTERVAL 1 DAY"))
    quarantine = _fresh_path(spark, "quarantine")
    good = tables.write_audit(spark, broken.unionByName(older), quarantine, "one")
    refused = spark.read.parquet(quarantine)
    both = good.withColumn("rule", F.lit(None).cast("string")).unionByName(refused.select(*good.columns, "rule"))
    return _stamp(both).select("ticker", "trade_date", "close_price", "ingested_at", "rule")


def _landed(spark, sf_dir) -> str:
    root = _fresh_path(spark, "landed")
    bronze.land_documents(documents_for(spark, sf_dir), root)
    return root


def q_landed_roundtrip(spark, sf_dir):
    """Documents landed as files, read back and flattened."""
    docs = bronze.read_bronze(spark, _landed(spark, sf_dir))
    return _stamp(fl.flatten_documents(docs, PROCESSED_AT).rows.select("date_key", *ROW_COLUMNS))


def q_landed_files(spark, sf_dir):
    """Every landed file by its name, and how many documents it holds."""
    from barlake.functions.json import documents_in
    files = bronze.read_bronze(spark, _landed(spark, sf_dir))
    return files.select(F.regexp_extract("source_file", r"[^/]+$", 0).alias("file_name"),
                        F.date_format(F.make_date("year", "month", "day"), "yyyy-MM-dd").alias("ingest_date"),
                        F.size(documents_in(F.col("value"))).alias("documents"))


def q_landed_batches(spark, sf_dir):
    """Files of several documents, with words before and behind them, read whole: rows, bad days and rests."""
    docs = documents_for(spark, sf_dir).where(~(_q() % 11).isin(5, 8, 10)).withColumn("b", (_q() / 4).cast("int"))
    ending = F.when(F.col("b") % 3 == 0, F.lit(' {"cut": ')).when(F.col("b") % 3 == 1, F.lit(" words behind")).otherwise(F.lit(""))
    # a file holds at most four pulls of one ticker
    files = docs.groupBy("ticker", "b").agg(F.sort_array(F.collect_list(F.struct("q", "value"))).alias("ds")).select(
        F.concat(F.when(F.col("b") % 5 == 0, F.lit("words before ")).otherwise(F.lit("")),
                 F.array_join("ds.value", "\n"), ending).alias("value"),
        F.concat_ws("_", "ticker", "b").alias("file_stem"), F.lit("2001").alias("year"), F.lit("12").alias("month"), F.lit("01").alias("day"))
    root = _fresh_path(spark, "landed-batches")
    bronze.land_documents(files, root)
    days = fl.flatten_documents(bronze.read_bronze(spark, root), PROCESSED_AT).days
    return days.select("ticker", "date_key", "reject_reason")


def q_landed_date(spark, sf_dir):
    """One processing date read from the landed files."""
    docs = bronze.read_bronze(spark, _landed(spark, sf_dir), "1998-06-01")
    return _stamp(fl.flatten_documents(docs, PROCESSED_AT).rows.select("date_key", *ROW_COLUMNS))


def q_run_accounting(spark, sf_dir):
    from barlake.operators import accounting
    from barlake.sources.tables import stage
    days = stage(spark, accounting.document_days(documents_for(spark, sf_dir), PROCESSED_AT), "days")
    return accounting.accounting(days)
