"""Small fixture builders shared by the tests."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta
from decimal import Decimal



def doc(ticker="AAPL", ts="2025-06-15T18:00:00.000000+00:00", series=None, source="alpha_vantage",
        metadata=True) -> str:
    body = {"raw_data": {"Meta Data": {"2. Symbol": ticker},
                         "Time Series (Daily)": series if series is not None else {}}}
    if metadata:
        body = {"metadata": {"ticker": ticker, "source": source, "ingestion_timestamp": ts},
                **body}
    return json.dumps(body)


def day(o="10.00", h="11.00", lo="9.00", c="10.50", v="1000", drop=()):
    d = {"1. open": o, "2. high": h, "3. low": lo, "4. close": c, "5. volume": v}
    return {k: val for k, val in d.items() if k not in drop}


def docs_df(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def staged_rows(spark, series: dict[str, list], start=date(2024, 1, 1), gap_every=None):
    """Staging-shaped rows: {ticker: [(close, volume), ...]} on consecutive (or gapped) days."""
    rows = []
    for t, values in series.items():
        d = start
        for i, (close, vol) in enumerate(values):
            c = Decimal(str(close)).quantize(Decimal("0.0001"))
            rows.append((t, d, c, c, c, c, vol, Decimal(0).quantize(Decimal("0.0001")), "test",
                         None, None))
            d += timedelta(days=3 if gap_every and (i + 1) % gap_every == 0 else 1)
    schema = ("ticker string, trade_date date, open_price decimal(12,4), high_price decimal(12,4), "
              "low_price decimal(12,4), close_price decimal(12,4), volume bigint, "
              "daily_range decimal(12,4), data_source string, ingested_at timestamp, "
              "processed_at timestamp")
    return spark.createDataFrame(rows, schema)


def silver_rows(spark, rows):
    """rows: (ticker, date, close, volume[, ingested_at])"""
    out = []
    for r in rows:
        t, d, c, v = r[:4]
        ing = r[4] if len(r) > 4 else datetime(2025, 1, 1)
        c = Decimal(str(c)).quantize(Decimal("0.0001"))
        out.append((t, d, c, c, c, c, v, "test", ing, ing))
    schema = ("ticker string, trade_date date, open_price decimal(12,4), high_price decimal(12,4), "
              "low_price decimal(12,4), close_price decimal(12,4), volume bigint, source string, "
              "ingested_at timestamp, processed_at timestamp")
    return spark.createDataFrame(out, schema)


def as_dicts(df, order=None):
    if order:
        df = df.orderBy(*order)
    return [r.asDict() for r in df.collect()]


RUN_TS = datetime(2025, 6, 16, 6, 0, 0)
