"""Partition-level merge: only touched months are read and rewritten."""

import contextlib
import io
import os
from datetime import date, datetime
from decimal import Decimal

from barlake.sources.merge import merge_into
from helpers import silver_rows


def files_of(path, part):
    d = os.path.join(path, f"trade_month={part}")
    return sorted(f for f in os.listdir(d) if f.endswith(".parquet"))


def test_merge_rewrites_touched_months_only(spark, tmp_path):
    path = str(tmp_path / "silver")
    jan = [("A", date(2025, 1, d), 10 + d, 1, datetime(2025, 2, 1)) for d in range(1, 6)]
    feb = [("A", date(2025, 2, d), 20 + d, 1, datetime(2025, 3, 1)) for d in range(1, 6)]
    merge_into(spark, path, silver_rows(spark, jan + feb))
    jan_files = files_of(path, "202501")
    later = [("A", date(2025, 2, 3), 99, 2, datetime(2025, 3, 2)),
             ("A", date(2025, 2, 4), 77, 2, datetime(2025, 2, 2)),   # older pull: loses
             ("A", date(2025, 3, 1), 30, 2, datetime(2025, 3, 2))]
    out = merge_into(spark, path, silver_rows(spark, later))
    assert files_of(path, "202501") == jan_files  # untouched month not rewritten
    out_rows = sorted(out.collect())
    got = {r.trade_date: r.close_price for r in out_rows}
    assert len(got) == 11
    assert got[date(2025, 2, 3)] == Decimal("99.0000")
    assert got[date(2025, 2, 4)] == Decimal("24.0000")
    assert got[date(2025, 3, 1)] == Decimal("30.0000")
    again = merge_into(spark, path, silver_rows(spark, later))  # replay: same result
    assert sorted(again.collect()) == out_rows


def test_merge_reads_only_touched_partitions(spark, tmp_path):
    import barlake.sources.merge as m
    from pyspark.sql import functions as F
    path = str(tmp_path / "silver")
    rows = [("A", date(2025, mm, 1), 10, 1, datetime(2025, 12, 1)) for mm in range(1, 13)]
    merge_into(spark, path, silver_rows(spark, rows))
    batch = m.with_partition(silver_rows(spark, rows[2:4]))
    months = m.touched_partitions(batch)
    assert months == [202503, 202504]
    q = spark.read.parquet(path).where(F.col("trade_month").isin(months))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain(mode="formatted")
    assert "IN (202503,202504)]" in buf.getvalue().split("PartitionFilters: ")[1].split("\n")[0]
    assert q.count() == 2


def test_empty_batch_leaves_table_untouched(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [("A", date(2025, 1, 1), 10, 1, datetime(2025, 2, 1))]
    merge_into(spark, path, silver_rows(spark, rows))
    before = files_of(path, "202501")
    out = merge_into(spark, path, silver_rows(spark, rows).limit(0))
    assert files_of(path, "202501") == before and out.count() == 1


def test_staged_copies_go_after_the_commit(spark, tmp_path):
    import os
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(folder))
    rows = silver_rows(spark, [("A", date(2025, 1, d), 10 + d, 1) for d in range(1, 5)])
    for _ in range(2):
        merge_into(spark, str(tmp_path / "silver"), rows)
    assert {n for n in set(os.listdir(folder)) - before if n.startswith("stage-")} == set()
