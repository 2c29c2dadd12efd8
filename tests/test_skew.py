"""Hot keys: one key holding a large share of all rows."""

from pyspark.sql import functions as F

from barlake.operators import quality
from barlake.operators.flatten import keep_latest


def copies(spark, n_hot=200_000, n_cold=1_000):
    """n_hot copies of one (ticker, date) key and n_cold single-copy keys."""
    hot = (spark.range(n_hot).repartition(8)
           .select(F.lit("HOT").alias("ticker"), F.lit("2025-01-02").cast("date").alias("trade_date"),
                   (F.lit("2025-01-01").cast("timestamp") + F.make_interval(secs=F.col("id")))
                   .alias("ingested_at"),
                   F.col("id").alias("pos"), (F.col("id") % 997).cast("decimal(12,4)").alias("close_price")))
    cold = (spark.range(n_cold)
            .select(F.concat(F.lit("T"), F.col("id").cast("string")).alias("ticker"),
                    F.lit("2025-01-02").cast("date").alias("trade_date"),
                    F.lit("2025-01-01").cast("timestamp").alias("ingested_at"),
                    F.col("id").alias("pos"), F.lit(1).cast("decimal(12,4)").alias("close_price")))
    return hot.unionByName(cold)


def test_hot_copies_dedupe(spark):
    rows = copies(spark)
    out = keep_latest(rows)
    got = out.where("ticker = 'HOT'").collect()
    assert len(got) == 1 and got[0].pos == 199_999  # newest ingest wins
    assert out.count() == 1_001
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in p  # copies reduced per map task before the shuffle


def test_hot_duplicate_count(spark):
    dups = quality.duplicate_keys(copies(spark), ["ticker", "trade_date"]).collect()
    assert [(r.ticker, r.n) for r in dups] == [("HOT", 200_000)]
