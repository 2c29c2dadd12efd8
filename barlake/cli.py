"""Command line for the daily run (submit with ``spark-submit -m``-style launchers or
``python -m barlake.cli``).

    python -m barlake.cli --bronze s3a://bucket/bronze/stocks --warehouse s3a://bucket/lake \\
        --seed s3a://bucket/seeds/tickers.csv --processing-date 2025-06-15

The session comes from the launcher's configuration (``getOrCreate``); the
checkpoint folder is the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from barlake.plans.pipeline import QualityCheckFailed, run_daily
from barlake.sources.seed import read_seed_csv


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="bronze -> silver -> models -> checks for one date")
    ap.add_argument("--bronze", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--seed", required=True, help="seed CSV with header")
    ap.add_argument("--processing-date", required=True, help="YYYY-MM-DD (ingest date folder)")
    ap.add_argument("--run-ts", help="stamp for all outputs, default now (UTC)")
    args = ap.parse_args(argv)
    run_ts = (datetime.fromisoformat(args.run_ts) if args.run_ts
              else datetime.now(timezone.utc).replace(tzinfo=None))
    spark = SparkSession.builder.appName("barlake-daily").getOrCreate()
    try:
        res = run_daily(spark, args.bronze, args.warehouse, args.processing_date, run_ts,
                        read_seed_csv(spark, args.seed))
        print(json.dumps({"version": res.silver_version, "counts": res.counts,
                          "checks": res.checks}, default=str))
        return 0
    except QualityCheckFailed as e:
        print(json.dumps({"failed": str(e), "checks": e.result.checks}, default=str))
        return 2


if __name__ == "__main__":
    raise SystemExit(main())
