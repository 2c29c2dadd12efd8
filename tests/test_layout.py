"""Files, tables and layout."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from barlake.sources import tables
from barlake.sources.bronze import envelope, land_documents, read_bronze, store_quarantine, triage_payloads
from helpers import silver_rows


def silver(spark):
    rows = [(t, date(2025, 1, d), 10 + d, 100 * d) for t in ("AAA", "BBB", "CCC")
            for d in range(1, 11)]
    return silver_rows(spark, rows)


def test_partitioned_silver_table_and_repair(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_silver(silver(spark), path, partition_by=["ticker"])
    assert sorted(p for p in os.listdir(path) if p.startswith("ticker=")) == [
        "ticker=AAA", "ticker=BBB", "ticker=CCC"]
    tables.create_schemas(spark, ["raw", "analytics"])
    tables.create_external_table(spark, "raw.silver_prices", path, tables.LANDING_SCHEMA,
                                 partition_by=["ticker"])
    assert spark.table("raw.silver_prices").count() == 0  # partitions not registered yet
    tables.repair_table(spark, "raw.silver_prices")
    t = spark.table("raw.silver_prices")
    assert t.count() == 30
    q = t.where(F.col("ticker") == "BBB").select("trade_date", "close_price")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ticker" in plan and "BBB" in plan
    assert q.count() == 10
    q2 = spark.read.parquet(path).where(F.col("close_price") > 15).select("trade_date")
    plan2 = q2._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(close_price), GreaterThan(close_price" in plan2
    assert "ReadSchema: struct<trade_date:date,close_price:decimal(12,4)>" in plan2


def test_dynamic_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_silver(silver(spark), path, partition_by=["ticker"])
    one = silver(spark).where(F.col("ticker") == "AAA").withColumn("volume", F.lit(7).cast("bigint"))
    tables.write_silver(one, path, partition_by=["ticker"])
    back = spark.read.parquet(path)
    assert back.count() == 30
    assert back.where("ticker = 'AAA' and volume = 7").count() == 10


def test_landing_conform_violations_reload_ctas_view(spark, tmp_path):
    df = silver(spark).unionByName(silver(spark).limit(1)) \
        .unionByName(silver(spark).limit(1).withColumn("ticker", F.lit("WAYTOOLONGTICKER")))
    conformed = tables.conform(df)
    found = {(r.check, r.detail): r.n for r in tables.landing_violations(conformed).collect()}
    assert found == {("max_length", "ticker"): 1, ("unique_key", "ticker,trade_date"): 1}
    path = str(tmp_path / "parquet")
    silver(spark).write.parquet(path)
    tables.create_schemas(spark, ["raw"])
    spark.sql("DROP TABLE IF EXISTS raw.stock_prices")
    spark.sql("CREATE TABLE raw.stock_prices (ticker string, trade_date date, open_price decimal(12,4), "
              "high_price decimal(12,4), low_price decimal(12,4), close_price decimal(12,4), "
              "volume bigint, source string, ingested_at timestamp, processed_at timestamp) USING parquet")
    tables.reload_table(spark, "raw.stock_prices", path)
    tables.reload_table(spark, "raw.stock_prices", path)
    assert spark.table("raw.stock_prices").count() == 30  # overwrite, not append
    tables.materialise_table(spark.table("raw.stock_prices").groupBy("ticker").count(), "t_counts")
    tables.materialise_table(spark.table("raw.stock_prices").groupBy("ticker").count(), "t_counts")
    assert spark.table("t_counts").count() == 3
    tables.materialise_view(spark.table("t_counts"), "v_counts")
    assert spark.sql("select sum(count) s from v_counts").first().s == 30


def test_sorted_clustered_files(spark, tmp_path):
    path = str(tmp_path / "clustered")
    tables.write_silver(silver(spark).repartition(5), path)
    parts = spark.read.parquet(path).withColumn("f", F.input_file_name())
    per_file = parts.groupBy("f").agg(F.countDistinct("ticker").alias("n")).collect()
    assert sum(r.n for r in per_file) <= 3 + len(per_file)  # tickers do not interleave across files


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_overwrites_do_not_depend_on_the_session(spark, tmp_path, mode):
    path = str(tmp_path / "silver")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        tables.write_silver(silver(spark), path, partition_by=["ticker"])
        tables.write_silver(silver(spark).where("ticker = 'AAA'").limit(4), path, partition_by=["ticker"])
        assert spark.read.parquet(path).count() == 24
        source, name = str(tmp_path / "source"), f"reload_{mode}"
        silver(spark).where("ticker <> 'CCC'").write.parquet(source)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        tables.create_external_table(spark, name, str(tmp_path / "table"), tables.LANDING_SCHEMA, ["ticker"])
        silver(spark).select(*spark.table(name).columns).write.insertInto(name)
        tables.reload_table(spark, name, source)
        assert sorted({r.ticker for r in spark.table(name).collect()}) == ["AAA", "BBB"]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_relative_location(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    tables.write_silver(silver(spark), "file:" + str(tmp_path / "lake"), partition_by=["ticker"])
    spark.sql("DROP TABLE IF EXISTS relative_table")
    tables.create_external_table(spark, "relative_table", "lake", tables.LANDING_SCHEMA, ["ticker"])
    tables.repair_table(spark, "relative_table")
    assert spark.table("relative_table").count() == 30


def test_landing_round_trip_and_pruning(spark, tmp_path):
    payloads = spark.createDataFrame(
        [("AAPL", "2025-06-15 18:00:00", '{"Time Series (Daily)": {"2025-06-13": {"4. close": "1"}}}'),
         ("MSFT", "2025-06-16 18:00:00", '{"Time Series (Daily)": {}}'),
         ("IBM", "2025-06-16 18:00:00", '{"Error Message": "Invalid API call."}'),
         ("IBM", "2025-06-16 18:01:00", '{"Note": null}'), ("IBM", "2025-06-16 18:02:00", "<html>busy</html>"),
         ("IBM", "2025-06-16 18:03:00", None), ("IBM", "2025-06-16 18:04:00", "[1]"),
         ("IBM", "2025-06-16 18:05:00", '{"cut": ')],
        "ticker string, ts string, payload string").withColumn("ts", F.to_timestamp("ts"))
    tri = triage_payloads(payloads)
    assert sorted(r.quarantine_reason for r in tri.quarantined.collect()) == [
        "error_message", "not_json", "not_json", "not_json", "not_json", "rate_limited"]
    for _ in range(2):  # a second run of the same dates replaces them
        store_quarantine(tri.quarantined, str(tmp_path / "quarantine"), F.col("ts"))
    assert spark.read.parquet(str(tmp_path / "quarantine")).where("ingest_date = '2025-06-16'").count() == 6
    docs = envelope(tri.accepted, F.col("ticker"), F.col("ts"))
    first = docs.where("ticker = 'AAPL'").first()
    assert first.file_stem == "AAPL_20250615_180000"
    assert '"ingestion_timestamp":"2025-06-15T18:00:00.000000+00:00"' in first.value
    root = str(tmp_path / "bronze")
    land_documents(docs, root)
    assert os.path.isdir(os.path.join(root, "year=2025", "month=06", "day=15"))
    day = read_bronze(spark, root, "2025-06-16")
    assert day.count() == 1 and day.select("year", "month", "day").first() == (2025, 6, 16)
    assert all("day=16" in f for f in day.inputFiles())  # only the day's folder is listed
    assert read_bronze(spark, root, "2031-01-01").count() == 0


def test_payloads_printed_over_many_lines_stay_one_document(spark, tmp_path):
    import json

    from barlake.operators.flatten import flatten_documents
    text = json.dumps({"Time Series (Daily)": {"2025-06-13": {"1. open": "1", "2. high": "1", "3. low": "1", "4. close": "1",
                                                              "5. volume": "5"}}}, indent=2)
    payloads = spark.createDataFrame([("A", text)], "ticker string, payload string")
    docs = envelope(payloads, F.col("ticker"), F.to_timestamp(F.lit("2025-06-15 18:00:00")))
    root = str(tmp_path / "bronze")
    land_documents(docs, root)
    got = flatten_documents(read_bronze(spark, root, "2025-06-15"), "2025-07-01 00:00:00")
    assert got.rows.count() == 1 and got.rejects.count() == 0


def test_rows_that_break_the_landing_rules_are_stored_and_not_published(spark, tmp_path):
    rows = silver(spark)
    long = rows.limit(1).withColumn("ticker", F.lit("X" * 11))
    none = rows.limit(1).withColumn("trade_date", F.lit(None).cast("date"))
    old = rows.where("ticker = 'AAA'").limit(2).withColumn("ingested_at", F.col("ingested_at") - F.expr("INTERVAL 1 DAY"))
    batch = rows.unionByName(long).unionByName(none).unionByName(old)
    quarantine = str(tmp_path / "quarantine")
    for _ in range(2):  # a repeated batch replaces what it stored
        good = tables.write_audit(spark, batch, quarantine, "2025-06-15")
        assert good.count() == 30 and good.exceptAll(rows.select(*good.columns)).count() == 0
        stored = spark.read.parquet(quarantine).groupBy("rule").count().collect()
        assert {r.rule: r["count"] for r in stored} == {"max_length:ticker": 1, "not_null:trade_date": 1, "unique_key:ticker,trade_date": 2}
    with pytest.raises(tables.BatchRefused, match="4 of 34"):
        tables.write_audit(spark, batch, quarantine, "2025-06-16", max_refused_share=0.1)


def test_readers_see_old_or_new_rows_while_a_table_is_reloaded(spark, tmp_path):
    import threading
    spark.sql("DROP VIEW IF EXISTS reloaded")
    rows = silver(spark)
    tables.publish(rows, "reloaded", str(tmp_path / "versions"), ["ticker"])
    source, counts, stop = str(tmp_path / "source"), [], threading.Event()
    rows.where("ticker <> 'CCC'").write.parquet(source)
    began = spark.table("reloaded")  # resolved before the switch: reads the old rows to its end

    def read():
        while not stop.is_set():
            counts.append(spark.table("reloaded").count())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        tables.reload_table(spark, "reloaded", source, str(tmp_path / "versions"), ["ticker"])
        assert spark.table("reloaded").count() == 20 and began.count() == 30
    finally:
        stop.set()
        reader.join()
    assert set(counts) <= {30, 20}
    for n in (10, 30):
        tables.materialise_table(rows.limit(n), "reloaded")
    assert spark.table("reloaded").count() == 30
    versions = [t.name for t in spark.catalog.listTables() if t.name.startswith("reloaded__v")]
    assert len(versions) == 2  # the last one before stays for its readers


def test_touched_partitions_are_registered_without_dropping_the_table(spark, tmp_path, monkeypatch):
    path, name = str(tmp_path / "months"), "months_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = silver(spark).withColumn("m", F.dayofmonth("trade_date"))
    rows.where("m <= 2").write.partitionBy("m").parquet(path)
    tables.register_partitions(spark, name, path, rows.schema, "m", [1, 2])
    assert spark.table(name).count() == 6
    rows.where("m = 3").write.mode("append").partitionBy("m").parquet(path)
    said, real = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (said.append(q), real(self, q, *a, **k))[1])
    tables.register_partitions(spark, name, path, rows.schema, "m", [3])
    assert not [q for q in said if q.startswith(("DROP", "MSCK"))]
    assert [q for q in said if q.startswith("ALTER")] == [f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (m=3)"]
    assert spark.table(name).count() == 9
    rows.write.partitionBy("m").parquet(str(tmp_path / "elsewhere"))
    tables.register_partitions(spark, name, str(tmp_path / "elsewhere"), rows.schema, "m", [3])
    assert spark.table(name).count() == 30


def test_a_reloaded_table_is_taken_over_by_the_run_and_reloaded_again(spark, tmp_path):
    path, other = str(tmp_path / "parquet"), str(tmp_path / "run")
    silver(spark).write.parquet(path)
    silver(spark).limit(7).write.parquet(other)
    tables.create_schemas(spark, ["raw"])
    schema = spark.read.parquet(path).schema
    tables.create_external_table(spark, "raw.taken", path, schema)
    for _ in range(2):
        tables.reload_table(spark, "raw.taken", path)  # a view of a version from here on
        assert spark.table("raw.taken").count() == 30
        for _ in range(2):
            tables.register_partitions(spark, "raw.taken", other, schema, None, None)
            assert spark.table("raw.taken").count() == 7
    assert len([t for t in spark.catalog.listTables("raw") if t.name.startswith("taken__v")]) == 2
