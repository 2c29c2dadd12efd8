"""Landing and reading are one format; nothing behind a document goes unnoticed."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from barlake.functions.json import documents_in, is_one_object
from barlake.operators import flatten as fl
from barlake.operators.accounting import account
from barlake.plans.pipeline import run_daily
from barlake.sources import bronze
from barlake.sources.seed import seed_from_rows
from helpers import day, doc, docs_df
from test_streaming import run as run_stream


def envelopes(spark, n=40):
    rows = [(f"T{i:02d}", json.dumps({"Time Series (Daily)": {"2025-06-13": day(c=f"{i + 1}.00", o=f"{i + 1}.00", h=f"{i + 1}.50", lo="0.50")}},
                                     indent=i % 3 or None)) for i in range(n)]
    payloads = spark.createDataFrame(rows, "ticker string, payload string").repartition(3)
    return bronze.envelope(payloads, F.col("ticker"), F.to_timestamp(F.lit("2025-06-15 18:00:00")))


def listed(root):
    return sorted(f for _, _, names in os.walk(root) for f in names if not f.startswith((".", "_")))


def test_forty_documents_in_forty_out(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for _ in range(2):  # landing again replaces the same files
        bronze.land_documents(envelopes(spark), root)
        assert listed(root) == [f"T{i:02d}_20250615_180000.json" for i in range(40)]
    docs = bronze.read_bronze(spark, root)
    assert docs.count() == 40
    silver, rejects, counts = account(docs, datetime(2025, 7, 1))
    assert silver.count() == 40 and rejects.count() == 0 and counts["documents"] == 40
    run_stream(spark, root, str(tmp_path / "silver"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 40
    seed = seed_from_rows(spark, [(f"T{i:02d}", "x", "Energy", "Large Cap") for i in range(40)])
    res = run_daily(spark, root, str(tmp_path / "wh"), "2025-06-15", datetime(2025, 6, 15, 20, 0), seed, catalog=False)
    assert res.counts["documents"] == 40 and spark.read.parquet(res.paths["silver"]).count() == 40


def test_names_are_one_to_a_document_and_safe(spark, tmp_path):
    rows = [("A", "x"), ("A", "y"), ("A", "z"), ("../up/../B", "b"), ("_hidden", "h"), (".dot", "d"), (None, "n"), ("C", ""), ("D", None)]
    docs = spark.createDataFrame(rows, "file_stem string, value string").selectExpr(
        "*", "'2025' as year", "'06' as month", "'15' as day")
    root = str(tmp_path / "bronze")
    bronze.land_documents(docs, root)
    assert listed(root) == sorted(["A.json", "A_2.json", "A_3.json", "..%2Fup%2F..%2FB.json".replace("..%2Fup", "%2E.%2Fup"), "%5Fhidden.json",
                                   "%2Edot.json", "UNKNOWN.json", "C.json", "D.json"])
    assert sorted(r.value for r in bronze.read_bronze(spark, root).collect()) == sorted(["x", "y", "z", "b", "h", "d", "n", "\n", "\n"])


def test_a_failed_task_leaves_no_listed_file(spark, tmp_path):
    root = str(tmp_path / "bronze")
    stuck = F.when(F.col("ticker") == "T17", F.raise_error(F.lit("lost"))).otherwise(F.col("value"))
    with pytest.raises(Exception, match="lost"):
        bronze.land_documents(envelopes(spark).withColumn("value", stuck), root)
    assert listed(root) == []
    bronze.land_documents(envelopes(spark), root)
    assert len(listed(root)) == 40


def test_an_aborted_job_removes_what_its_tasks_wrote(tmp_path):
    from types import SimpleNamespace

    from barlake.sources.landing import landed_documents_source
    writer = landed_documents_source()({"path": str(tmp_path)}).writer(None, False)
    row = SimpleNamespace(value="x", file_name="A.json", year="2025", month="06", day="15")
    done = writer.write(iter([row]))
    folder = tmp_path / "year=2025" / "month=06" / "day=15"
    assert [f.startswith(".") for f in os.listdir(folder)] == [True]
    writer.abort([done, None])
    assert os.listdir(folder) == []

    def broken():
        yield row
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(broken())
    assert os.listdir(folder) == []
    writer.commit([writer.write(iter([row])), None])
    assert os.listdir(folder) == ["A.json"]


DAY = {"2025-06-13": day()}


@pytest.mark.parametrize(("text", "documents", "rests"), [
    (doc("A", series=DAY), 1, 0),
    (doc("A", series=DAY) + "\n", 1, 0),
    (doc("A", series=DAY) + " {bad", 1, 1),
    (doc("A", series=DAY) + " words", 1, 1),
    ("words " + doc("A", series=DAY), 1, 1),
    (doc("A", series=DAY) + doc("B", series=DAY), 2, 0),
    ("\n".join(doc(t, series=DAY) for t in "ABC"), 3, 0),
    ("\n".join([doc("A", series=DAY), doc("B", series=DAY)[:60], doc("C", series=DAY)]), 2, 1),
    (json.dumps(json.loads(doc("A", series=DAY)), indent=2) * 2, 2, 0),
    (doc("}{ \\\" }{", series=DAY) + "{" + doc("B", series=DAY), 2, 1),
    (doc("A", series=DAY) + "]", 0, 1), (doc("A", series=DAY) + "}", 0, 1), (doc("A", series=DAY) + "," + doc("B", series=DAY), 0, 1),
    ("[" + doc("A", series=DAY) + "]", 0, 1), ("", 0, 1), (" \n", 0, 1), (None, 0, 1), ("{", 0, 1), ("{}", 0, 0),
    (doc("A", series=DAY).replace('"10.50"', "NaN"), 0, 0),
])
def test_documents_and_rests(spark, text, documents, rests):
    flat = fl.flatten_documents(docs_df(spark, [text]), datetime(2025, 7, 1))
    assert flat.rows.count() == documents
    assert flat.rejects.where("reject_reason = 'unparseable_document'").count() == rests


def test_a_long_file_is_split_in_one_pass(spark):
    lines = spark.range(1).select(F.concat(F.repeat(F.lit('{"a": {"b": "x}{", "c": [1, {"d": 4}]}}\n'), 100_000), F.lit("rest")).alias("t"))
    got = lines.select(F.explode(documents_in(F.col("t"))).alias("p")).groupBy("p.one_object").count().collect()
    assert {r.one_object: r["count"] for r in got} == {True: 100_000, False: 1}
    assert [r[0] for r in docs_df(spark, ['{"a":1}', '{"a":1} x', None, "1"]).select(is_one_object(F.col("value"))).collect()] == \
        [True, False, False, False]
