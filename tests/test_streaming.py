"""Files arriving over several runs are merged into silver exactly once."""

import json
import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException

from barlake.streaming.arrival import start_arrival
from helpers import day, doc


def land(root, ymd, name, text):
    y, m, d = ymd.split("-")
    folder = os.path.join(root, f"year={y}", f"month={m}", f"day={d}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def run(spark, bronze, silver, ck):
    q = start_arrival(spark, bronze, silver, ck, processed_at=datetime(2025, 7, 1))
    q.awaitTermination(120)
    assert q.exception() is None


def closes(spark, silver):
    return {r.trade_date: r.close_price for r in spark.read.parquet(silver).collect()}


def test_arrival_runs(spark, tmp_path):
    bronze, silver, ck = (str(tmp_path / n) for n in ("bronze", "silver", "ck"))
    os.makedirs(bronze)
    land(bronze, "2025-06-14", "A_1.json",
         doc("A", "2025-06-14T18:00:00+00:00", {"2025-05-30": day(c="1.00"), "2025-06-12": day(c="1.00"),
                                                "2025-06-13": day(c="2.00")}))
    run(spark, bronze, silver, ck)
    # a newer pull revises 06-13; an older pull for 06-12 lands late and must lose
    land(bronze, "2025-06-15", "A_2.json",
         doc("A", "2025-06-15T18:00:00+00:00", {"2025-06-13": day(c="3.00"), "2025-06-14": day(c="4.00")}))
    land(bronze, "2025-06-15", "A_0.json",
         doc("A", "2025-06-10T18:00:00+00:00", {"2025-06-12": day(c="9.00")}))
    may = sorted(os.listdir(os.path.join(silver, "trade_month=202505")))
    run(spark, bronze, silver, ck)
    assert sorted(os.listdir(os.path.join(silver, "trade_month=202505"))) == may  # untouched
    want = {date(2025, 5, 30): Decimal("1.0000"), date(2025, 6, 12): Decimal("1.0000"),
            date(2025, 6, 13): Decimal("3.0000"), date(2025, 6, 14): Decimal("4.0000")}
    assert closes(spark, silver) == want
    run(spark, bronze, silver, ck)  # nothing new: nothing changes
    assert closes(spark, silver) == want


def printed(text):
    return json.dumps(json.loads(text), indent=2)


def test_documents_printed_over_many_lines(spark, tmp_path):
    bronze, silver, ck = (str(tmp_path / n) for n in ("bronze", "silver", "ck"))
    os.makedirs(bronze)
    land(bronze, "2025-06-14", "A_1.json", printed(doc("A", "2025-06-14T18:00:00+00:00", {"2025-06-12": day(c="1.00")})))
    run(spark, bronze, silver, ck)
    assert closes(spark, silver) == {date(2025, 6, 12): Decimal("1.0000")}


def test_rejects_are_stored_and_a_lost_batch_stops_the_stream(spark, tmp_path):
    bronze, silver, ck = (str(tmp_path / n) for n in ("bronze", "silver", "ck"))
    os.makedirs(bronze)
    land(bronze, "2025-06-14", "A_1.json", doc("A", "2025-06-14T18:00:00+00:00",
                                               {"2025-06-12": day(c="1.00"), "2025-06-13": day(c="abc")}))
    run(spark, bronze, silver, ck)
    stored = spark.read.parquet(silver + "_rejects").collect()
    assert [(r.ticker, r.date_key, r.reject_reason, r.batch_id) for r in stored] == [("A", "2025-06-13", "bad_close", 0)]
    counts = spark.read.parquet(silver + "_counts").collect()
    assert [(r.batch_id, r.documents, r.parsed_days, r.rejected_days, r.final_rows) for r in counts] == [(0, 1, 1, 1, 1)]
    land(bronze, "2025-06-15", "A_2.json", "<html>busy</html>")
    q = start_arrival(spark, bronze, silver, ck, processed_at=datetime(2025, 7, 1))
    with pytest.raises(StreamingQueryException, match="could not be parsed"):
        q.awaitTermination(120)


def test_batch_failing_half_way_is_replayed(spark, tmp_path, monkeypatch):
    import barlake.sources.merge as merge_mod
    from barlake.sources.tables import stage
    bronze, silver, ck = (str(tmp_path / n) for n in ("bronze", "silver", "ck"))
    os.makedirs(bronze)
    land(bronze, "2025-06-14", "A_1.json",
         doc("A", "2025-06-14T18:00:00+00:00", {"2025-06-12": day(c="1.00"), "2025-06-13": day(c="2.00")}))
    run(spark, bronze, silver, ck)

    land(bronze, "2025-06-15", "A_2.json",
         doc("A", "2025-06-15T18:00:00+00:00", {"2025-06-13": day(c="3.00")}))
    real = merge_mod.merge_into

    def crash(spark_, path, incoming, *a, **k):
        stage(spark_, incoming, "half-way")  # work done, then the driver is lost
        raise RuntimeError("lost")

    monkeypatch.setattr(merge_mod, "merge_into", crash)
    q = start_arrival(spark, bronze, silver, ck, processed_at=datetime(2025, 7, 1))
    try:
        q.awaitTermination(120)
    except Exception:
        pass
    assert q.exception() is not None
    monkeypatch.setattr(merge_mod, "merge_into", real)
    run(spark, bronze, silver, ck)  # restart from the checkpoint: batch replayed
    got = {r.trade_date: r.close_price for r in spark.read.parquet(silver).collect()}
    assert got == {date(2025, 6, 12): Decimal("1.0000"), date(2025, 6, 13): Decimal("3.0000")}
