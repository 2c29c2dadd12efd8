"""Independent SQL oracle texts (DuckDB dialect) for the harness keys.

Written in integer arithmetic (prices in cents, returns in micro units,
averages as half-up integer division) rather than mirroring the decimal
expressions of the Spark code, so that agreement means something.
Tables ``nation region supplier lineitem ...`` are views over the parquet
files.
"""

from __future__ import annotations

# Bars: one row per (nation, ship date). c/o/h/lo in cents, v volume.
BARS = """
geo AS (
  SELECT n_nationkey, n_name AS ticker, r_name AS sector
  FROM nation JOIN region ON n_regionkey = r_regionkey),
trades AS (
  SELECT g.ticker, g.sector, CAST(l.l_shipdate AS DATE) AS trade_date,
         l.l_orderkey AS ok, l.l_linenumber AS ln,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents,
         l.l_quantity AS qty
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN geo g ON s.s_nationkey = g.n_nationkey),
bars AS (
  SELECT ticker, sector, trade_date,
         arg_min(cents, (ok, ln, cents)) AS o, max(cents) AS h, min(cents) AS lo,
         arg_max(cents, (ok, ln, cents)) AS c, CAST(sum(qty) AS BIGINT) AS v
  FROM trades GROUP BY ticker, sector, trade_date)"""

# Staged rows: only positive closes (all bars qualify, the filter is kept).
STAGED = BARS + """,
stg AS (SELECT * FROM bars WHERE c > 0)"""

# Indicators in integer units: rm micro-return, sma in 1e-4, vol micro, vsma integer.
INDICATORS = STAGED + """,
base AS (
  SELECT ticker, trade_date, o, h, lo, c, v,
         lag(c) OVER (PARTITION BY ticker ORDER BY trade_date) AS p
  FROM stg),
ret AS (
  SELECT *, CASE WHEN p > 0 THEN
           (CASE WHEN c < p THEN -1 ELSE 1 END) * ((2 * abs(c - p) * 1000000 + p) // (2 * p))
         END AS rm
  FROM base),
sums AS (
  SELECT *,
    sum(c) OVER w20 AS s20, count(c) OVER w20 AS n20,
    sum(c) OVER w50 AS s50, count(c) OVER w50 AS n50,
    sum(rm) OVER w20 AS sr, sum(rm * rm) OVER w20 AS srr, count(rm) OVER w20 AS nr,
    sum(v) OVER w20 AS sv, count(v) OVER w20 AS nv
  FROM ret
  WINDOW w20 AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
         w50 AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)),
ind AS (
  SELECT ticker, trade_date, o, h, lo, c, v, rm,
    (2 * s20 * 100 + n20) // (2 * n20) AS sma20,
    (2 * s50 * 100 + n50) // (2 * n50) AS sma50,
    CASE WHEN nr >= 2 THEN
      CAST(floor(sqrt(CAST(nr * srr - sr * sr AS DOUBLE) / CAST(nr * (nr - 1) AS DOUBLE)) + 0.5) AS BIGINT)
    END AS volu,
    CASE WHEN nv > 0 THEN CAST((2 * sv + nv) // (2 * nv) AS BIGINT) END AS vsma
  FROM sums),
ind2 AS (
  SELECT *, COALESCE(sma20 > sma50, false) AS xover,
    CASE WHEN vsma > 0 THEN (2 * v * 10000 + vsma) // (2 * vsma) END AS relv
  FROM ind)"""

DIM = """
dim AS (
  SELECT n_name AS ticker, n_name || ' Holdings & Co' AS company_name, r_name AS sector,
         CASE WHEN n_nationkey < 10 THEN 'Large Cap' ELSE 'Mid Cap' END AS market_cap_category
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

DAILY = INDICATORS + "," + DIM + """,
daily AS (
  SELECT i.*, d.company_name, d.sector AS dsector
  FROM ind2 i LEFT JOIN dim d ON i.ticker = d.ticker)"""

SECTOR = DAILY + """,
sec AS (
  SELECT dsector AS sector, trade_date,
    sum(rm) AS srm, count(rm) AS nrm, max(rm) AS best, min(rm) AS worst,
    sum(v) AS sv, count(v) AS nv, sum(volu) AS svol, count(volu) AS nvol,
    count(ticker) AS stock_count,
    count(*) FILTER (WHERE rm > 0) AS adv,
    count(*) FILTER (WHERE rm < 0) AS dec,
    count(*) FILTER (WHERE xover) AS bull
  FROM daily WHERE rm IS NOT NULL
  GROUP BY dsector, trade_date)"""


def _sql(ctes: str, select: str) -> str:
    return "WITH " + ctes.strip() + "\n" + select.strip()


ORACLE: dict[str, str] = {
    "staging": _sql(STAGED, """
SELECT ticker, trade_date, o / 100.0 AS open_price, h / 100.0 AS high_price,
       lo / 100.0 AS low_price, c / 100.0 AS close_price, v AS volume,
       (h - lo) / 100.0 AS daily_range, 'lineitem' AS data_source
FROM stg"""),
    "indicators": _sql(INDICATORS, """
SELECT ticker, trade_date, c / 100.0 AS close_price, v AS volume,
       rm / 1000000.0 AS daily_return, sma20 / 10000.0 AS sma_20, sma50 / 10000.0 AS sma_50,
       volu / 1000000.0 AS volatility_20d, vsma AS volume_sma_20,
       relv / 10000.0 AS relative_volume, xover AS sma_crossover
FROM ind2"""),
    "daily_trading": _sql(DAILY, """
SELECT ticker, company_name, dsector AS sector, trade_date,
       o / 100.0 AS open_price, h / 100.0 AS high_price, lo / 100.0 AS low_price,
       c / 100.0 AS close_price, v AS volume, (h - lo) / 100.0 AS daily_range,
       rm / 1000000.0 AS daily_return, sma20 / 10000.0 AS sma_20, sma50 / 10000.0 AS sma_50,
       volu / 1000000.0 AS volatility_20d, vsma AS volume_sma_20,
       relv / 10000.0 AS relative_volume, xover AS sma_crossover,
       CAST(year(trade_date) AS BIGINT) AS trade_year,
       CAST(month(trade_date) AS BIGINT) AS trade_month,
       CAST(dayofweek(trade_date) AS BIGINT) AS day_of_week
FROM daily"""),
    "sector_performance": _sql(SECTOR, """
SELECT sector, trade_date,
       (CASE WHEN srm < 0 THEN -1 ELSE 1 END) * ((2 * abs(srm) + nrm) // (2 * nrm)) / 1000000.0
         AS avg_daily_return,
       best / 1000000.0 AS best_return, worst / 1000000.0 AS worst_return,
       CAST(sv AS BIGINT) AS total_volume,
       CAST((2 * sv + nv) // (2 * nv) AS BIGINT) AS avg_volume,
       ((2 * svol + nvol) // (2 * nvol)) / 1000000.0 AS avg_volatility,
       stock_count, adv AS advancing_stocks, dec AS declining_stocks,
       bull AS bullish_crossover_count,
       CASE WHEN stock_count > 0 THEN ((2 * adv * 10000 + stock_count) // (2 * stock_count)) / 10000.0
       END AS advance_decline_ratio
FROM sec"""),
    "sma_generic": _sql(STAGED, """
SELECT ticker, trade_date,
  ((2 * sum(c) OVER w5 * 100 + count(c) OVER w5) // (2 * count(c) OVER w5)) / 10000.0 AS sma_5_close,
  ((2 * sum(v) OVER w10 * 10000 + count(v) OVER w10) // (2 * count(v) OVER w10)) / 10000.0
    AS sma_10_volume
FROM stg
WINDOW w5 AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
       w10 AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"""),
}

SECTOR_AVG = SECTOR + """,
secf AS (
  SELECT sector, trade_date,
    (CASE WHEN srm < 0 THEN -1 ELSE 1 END) * ((2 * abs(srm) + nrm) // (2 * nrm)) AS avgr
  FROM sec)"""

ORACLE.update({
    "latest_prices": _sql(BARS, """
SELECT ticker, trade_date, o / 100.0 AS open_price, c / 100.0 AS close_price, v AS volume
FROM bars WHERE trade_date = (SELECT max(trade_date) FROM bars)"""),
    "top_movers": _sql(BARS + """,
lp AS (SELECT ticker, trade_date, c,
              lag(c) OVER (PARTITION BY ticker ORDER BY trade_date) AS p FROM bars)""", """
SELECT ticker, trade_date, c / 100.0 AS close_price, p / 100.0 AS prev_close,
       (CASE WHEN c < p THEN -1 ELSE 1 END) * ((2 * abs(c - p) * 10000 + p) // (2 * p)) / 100.0
         AS pct_change
FROM lp WHERE trade_date = (SELECT max(trade_date) FROM lp) AND p IS NOT NULL"""),
    "price_history": _sql(BARS, """
SELECT ticker, trade_date, o / 100.0 AS open_price, h / 100.0 AS high_price,
       lo / 100.0 AS low_price, c / 100.0 AS close_price, v AS volume
FROM bars WHERE ticker = 'NATION_7' ORDER BY trade_date DESC LIMIT 20"""),
    "volume_spikes": _sql(BARS + """,
va AS (SELECT ticker, trade_date, v, sum(v) OVER w AS sv, count(v) OVER w AS n FROM bars
       WINDOW w AS (PARTITION BY ticker ORDER BY trade_date
                    ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))""", """
SELECT ticker, trade_date, v AS volume, CAST((2 * sv + n) // (2 * n) AS BIGINT) AS avg_volume_20d,
       ((2 * v * n * 100 + sv) // (2 * sv)) / 100.0 AS relative_volume
FROM va WHERE n > 0 AND sv > 0 AND v * n > 2 * sv"""),
    "monthly_average": _sql(BARS, """
SELECT ticker, CAST(date_trunc('month', trade_date) AS DATE) AS month,
       ((2 * sum(c) + count(c)) // (2 * count(c))) / 100.0 AS avg_close,
       CAST((2 * sum(v) + count(v)) // (2 * count(v)) AS BIGINT) AS avg_volume,
       count(*) AS trading_days
FROM bars GROUP BY ticker, CAST(date_trunc('month', trade_date) AS DATE)"""),
    "dq_not_null": _sql(SECTOR, """
SELECT 'stock_prices' AS model, 'ticker' AS column_name, count(*) FILTER (WHERE ticker IS NULL) AS null_count FROM bars
UNION ALL SELECT 'stock_prices', 'trade_date', count(*) FILTER (WHERE trade_date IS NULL) FROM bars
UNION ALL SELECT 'stock_prices', 'open_price', count(*) FILTER (WHERE o IS NULL) FROM bars
UNION ALL SELECT 'stock_prices', 'close_price', count(*) FILTER (WHERE c IS NULL) FROM bars
UNION ALL SELECT 'fct_daily_trading', 'ticker', count(*) FILTER (WHERE ticker IS NULL) FROM daily
UNION ALL SELECT 'fct_daily_trading', 'trade_date', count(*) FILTER (WHERE trade_date IS NULL) FROM daily
UNION ALL SELECT 'fct_daily_trading', 'close_price', count(*) FILTER (WHERE c IS NULL) FROM daily
UNION ALL SELECT 'fct_daily_trading', 'sector', count(*) FILTER (WHERE dsector IS NULL) FROM daily
UNION ALL SELECT 'fct_sector_performance', 'sector', count(*) FILTER (WHERE sector IS NULL) FROM sec
UNION ALL SELECT 'fct_sector_performance', 'trade_date', count(*) FILTER (WHERE trade_date IS NULL) FROM sec
UNION ALL SELECT 'fct_sector_performance', 'stock_count', count(*) FILTER (WHERE stock_count IS NULL) FROM sec
UNION ALL SELECT 'dim_stocks', 'ticker', count(*) FILTER (WHERE ticker IS NULL) FROM dim
UNION ALL SELECT 'dim_stocks', 'company_name', count(*) FILTER (WHERE company_name IS NULL) FROM dim
UNION ALL SELECT 'dim_stocks', 'sector', count(*) FILTER (WHERE sector IS NULL) FROM dim"""),
    "dq_unique": _sql(BARS + "," + DIM, """
SELECT 'dim_stocks' AS model, ticker AS key_value, count(*) AS n FROM dim
GROUP BY ticker HAVING count(*) > 1
UNION ALL
SELECT 'stock_prices', ticker || '|' || CAST(trade_date AS VARCHAR), count(*) FROM bars
GROUP BY ticker, trade_date HAVING count(*) > 1"""),
    "dq_accepted_values": _sql(DAILY, """
SELECT dsector AS sector, count(*) AS n FROM daily
WHERE dsector IS NOT NULL
  AND dsector NOT IN ('Technology', 'Financials', 'Healthcare', 'Energy', 'Consumer Staples')
GROUP BY dsector"""),
    "dq_return_range": _sql(DAILY, """
SELECT ticker, trade_date, rm / 1000000.0 AS daily_return FROM daily
WHERE rm IS NOT NULL AND abs(rm) > 500000"""),
    "dq_freshness": _sql(BARS + """,
f AS (SELECT ticker, max(CAST(trade_date AS TIMESTAMP) + INTERVAL 30 HOUR) AS m
      FROM bars GROUP BY ticker),
g AS (SELECT ticker, m, date_diff('second', m, TIMESTAMP '2001-11-06 12:00:00') AS age FROM f)""", """
SELECT ticker, strftime(m, '%Y-%m-%d %H:%M:%S') AS max_loaded_at, age / 3600.0 AS age_hours,
       CASE WHEN age > 48 * 3600 THEN 'error' WHEN age > 24 * 3600 THEN 'warn' ELSE 'pass' END
         AS status
FROM g"""),
    "sector_heatmap": _sql(SECTOR_AVG, """
SELECT sector, trade_date, max(avgr) / 1000000.0 AS avg_daily_return FROM secf GROUP BY sector, trade_date"""),
    "top_gainers": _sql(DAILY, """
SELECT ticker, company_name, dsector AS sector, trade_date, c / 100.0 AS close_price,
       rm / 1000000.0 AS daily_return
FROM daily WHERE trade_date = (SELECT max(trade_date) FROM daily) AND rm IS NOT NULL
ORDER BY rm DESC, ticker LIMIT 5"""),
    "crossover_signals": _sql(INDICATORS, """
SELECT ticker, trade_date, c / 100.0 AS close_price, sma20 / 10000.0 AS sma_20,
       sma50 / 10000.0 AS sma_50
FROM ind2 WHERE xover"""),
    "volatility_by_stock": _sql(DAILY, """
SELECT ticker, dsector AS sector, max(trade_date) AS last_date,
       arg_max(volu, trade_date) / 1000000.0 AS latest_volatility,
       max(volu) / 1000000.0 AS max_volatility, count(volu) AS days
FROM daily WHERE volu IS NOT NULL GROUP BY ticker, dsector"""),
    "relative_volume_spikes": _sql(INDICATORS, """
SELECT ticker, trade_date, v AS volume, vsma AS volume_sma_20, relv / 10000.0 AS relative_volume
FROM ind2 WHERE relv IS NOT NULL AND relv > 20000"""),
})

# Bronze pulls re-derived from the fault rules (see plans.bronze_harness), no JSON.
BRONZE = BARS + """,
pulls AS (
  SELECT ticker, trade_date, r, year(trade_date) * 12 + month(trade_date) - 1 + r AS q,
         dayofyear(trade_date) AS doy,
         o + 2 - r AS o, h + 2 - r AS h, lo + 2 - r AS lo, c + 2 - r AS c, v + 2 - r AS v
  FROM (SELECT *, unnest([0, 1, 2]) AS r FROM bars)),
pf AS (
  SELECT *, CASE
      WHEN r = 2 AND doy % 17 = 0 THEN 'abc_close'
      WHEN r = 2 AND doy % 31 = 0 THEN 'null_high'
      WHEN r = 1 AND doy % 37 = 0 THEN 'not_object'
      WHEN r = 2 AND doy % 41 = 0 THEN 'decimal_volume'
      WHEN r = 2 AND doy % 43 = 0 THEN 'nan_low'
      WHEN r = 2 AND doy % 29 = 0 THEN 'missing_open'
      WHEN doy % 13 = 0 THEN 'missing_volume'
      ELSE 'none' END AS fault
  FROM pulls),
ing AS (
  SELECT ticker, q,
    CASE WHEN q % 13 = 7 THEN 'error_message' WHEN q % 23 = 9 THEN 'rate_limited'
         WHEN q % 29 = 11 THEN 'not_json'
         WHEN q % 11 IN (5, 8, 10) THEN 'rejected' WHEN q % 19 = 0 THEN 'skipped'
         ELSE 'ok' END AS st,
    make_timestamp(CAST((q + 1) // 12 AS BIGINT), CAST((q + 1) % 12 + 1 AS BIGINT), 1, 18, 0, 0.0) AS ts
  FROM (SELECT DISTINCT ticker, q FROM pulls)),
frows AS (
  SELECT p.ticker, p.trade_date, CAST(p.trade_date AS VARCHAR) AS date_key,
         CASE WHEN fault = 'missing_open' THEN 0 ELSE o END AS o, h, lo, c,
         CASE WHEN fault = 'missing_volume' THEN 0 ELSE v END AS v,
         'alpha_vantage' AS source, i.ts
  FROM pf p JOIN ing i ON p.ticker = i.ticker AND p.q = i.q
  WHERE i.st = 'ok'
    AND fault NOT IN ('abc_close', 'null_high', 'not_object', 'decimal_volume', 'nan_low')
  UNION ALL
  SELECT ticker, NULL, lpad(CAST(q // 12 AS VARCHAR), 4, '0') || '-13-40',
         100, 100, 100, 100, 100, 'alpha_vantage', ts
  FROM ing WHERE st = 'ok' AND q % 5 = 0),
crow AS (
  SELECT * FROM frows
  WHERE trade_date IS NOT NULL AND c > 0 AND o > 0 AND h > 0 AND lo > 0 AND v >= 0),
srow AS (
  SELECT * FROM crow
  QUALIFY row_number() OVER (PARTITION BY ticker, trade_date ORDER BY ts DESC) = 1)"""

_ROW_OUT = """ticker, trade_date, o / 100.0 AS open_price, h / 100.0 AS high_price,
       lo / 100.0 AS low_price, c / 100.0 AS close_price, v AS volume, source,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ingested_at"""

ORACLE.update({
    "event_props": """
SELECT event_type, count(*) AS events,
       count(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS with_k,
       CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       min(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS min_k,
       max(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS max_k
FROM events GROUP BY event_type""",
    "payload_triage": _sql(BRONZE, """
SELECT ticker, strftime(ts, '%Y-%m-%d %H:%M:%S') AS fetched_at, st AS quarantine_reason
FROM ing WHERE st IN ('error_message', 'rate_limited', 'not_json')"""),
    "bronze_roundtrip": _sql(BRONZE, "SELECT date_key, " + _ROW_OUT + " FROM frows"),
    "bronze_rejects": _sql(BRONZE, """
SELECT 'unparseable_document' AS reject_reason, count(*) AS n FROM ing WHERE st = 'rejected'
HAVING count(*) > 0
UNION ALL
SELECT CASE fault WHEN 'abc_close' THEN 'bad_close' WHEN 'null_high' THEN 'bad_high'
                  WHEN 'not_object' THEN 'day_not_object' WHEN 'decimal_volume' THEN 'bad_volume'
                  WHEN 'nan_low' THEN 'bad_low' END AS reject_reason,
       count(*) AS n
FROM pf p JOIN ing i ON p.ticker = i.ticker AND p.q = i.q
WHERE i.st = 'ok' AND fault IN ('abc_close', 'null_high', 'not_object', 'decimal_volume', 'nan_low')
GROUP BY 1"""),
    "silver_clean": _sql(BRONZE, "SELECT " + _ROW_OUT + " FROM crow"),
    "silver_dedupe": _sql(BRONZE, "SELECT " + _ROW_OUT + " FROM srow"),
    "silver_upsert": _sql(BRONZE, "SELECT " + _ROW_OUT + " FROM srow"),
    "silver_merge": _sql(BRONZE, "SELECT " + _ROW_OUT + " FROM srow"),
})

ORACLE["dq_unique"] = _sql(BRONZE + "," + DIM, """
SELECT 'dim_stocks' AS model, ticker AS key_value, count(*) AS n FROM dim
GROUP BY ticker HAVING count(*) > 1
UNION ALL
SELECT 'stock_prices', ticker || '|' || CAST(trade_date AS VARCHAR), count(*) FROM bars
GROUP BY ticker, trade_date HAVING count(*) > 1
UNION ALL
SELECT 'silver_clean', ticker || '|' || CAST(trade_date AS VARCHAR), count(*) FROM crow
GROUP BY ticker, trade_date HAVING count(*) > 1""")

ORACLE.update({
    "ticker_filter": _sql(BARS, """
SELECT ticker, count(*) AS days, max(trade_date) AS last_date, CAST(sum(v) AS BIGINT) AS total_volume
FROM bars WHERE ticker IN ('NATION_1', 'NATION_3', 'NATION_5', 'NATION_24')
GROUP BY ticker"""),
    "row_count": _sql(BARS, "SELECT count(*) AS row_count FROM bars"),
})

# Short stretches give the same rows.
ORACLE["indicators_split"] = ORACLE["indicators"]

# Written to storage and read back: the same rows.
ORACLE["silver_by_ticker"] = ORACLE["table_reload"] = ORACLE["silver_dedupe"]
ORACLE["landed_roundtrip"] = ORACLE["bronze_roundtrip"]
ORACLE["landed_date"] = _sql(BRONZE, "SELECT date_key, " + _ROW_OUT + " FROM frows WHERE CAST(ts AS DATE) = DATE '1998-06-01'")
ORACLE["landing_quarantine"] = _sql(BRONZE + """,
changed AS (
  SELECT CASE WHEN dayofyear(trade_date) % 17 = 0 THEN ticker || '_TOO_LONG' WHEN dayofyear(trade_date) % 31 = 0 THEN NULL ELSE ticker END AS ticker,
         trade_date, c, ts, dayofyear(trade_date) AS doy FROM srow),
ruled AS (
  SELECT *, CASE WHEN ticker IS NULL THEN 'not_null:ticker' WHEN length(ticker) > 10 THEN 'max_length:ticker'
                 WHEN doy % 23 = 0 THEN 'max_length:source' END AS rule FROM changed)""", """
SELECT ticker, trade_date, c / 100.0 AS close_price, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ingested_at, rule FROM ruled
UNION ALL
SELECT ticker, trade_date, c / 100.0, strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S'), coalesce(rule, 'unique_key:ticker,trade_date')
FROM ruled WHERE doy % 29 = 0""")
# the name of a document shows the ticker as the payload does, in upper case, and the ingest time
ORACLE["landed_files"] = _sql(BRONZE, """
SELECT ticker || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS file_name, strftime(ts, '%Y-%m-%d') AS ingest_date,
       CAST(1 AS BIGINT) AS documents
FROM ing WHERE st IN ('ok', 'rejected', 'skipped')""")
ORACLE["landed_batches"] = _sql(BRONZE, """
SELECT f.ticker, date_key, CAST(NULL AS VARCHAR) AS reject_reason FROM frows f
UNION ALL
SELECT p.ticker, CAST(p.trade_date AS VARCHAR),
       CASE fault WHEN 'abc_close' THEN 'bad_close' WHEN 'null_high' THEN 'bad_high'
                  WHEN 'not_object' THEN 'day_not_object' WHEN 'decimal_volume' THEN 'bad_volume'
                  WHEN 'nan_low' THEN 'bad_low' END
FROM pf p JOIN ing i ON p.ticker = i.ticker AND p.q = i.q
WHERE i.st = 'ok' AND fault IN ('abc_close', 'null_high', 'not_object', 'decimal_volume', 'nan_low')
UNION ALL
SELECT NULL, NULL, 'unparseable_document'
FROM (SELECT DISTINCT ticker, q // 4 AS b FROM ing WHERE st IN ('ok', 'skipped')) files,
     (SELECT unnest([1, 2]) AS part)
WHERE (part = 1 AND b % 3 IN (0, 1)) OR (part = 2 AND b % 5 = 0)""")
ORACLE["staging_view"] = ORACLE["staging"]
ORACLE["incremental_indicators"] = ORACLE["indicators"]
ORACLE["bucketed_daily"] = ORACLE["daily_trading"]
ORACLE["sector_delta"] = ORACLE["sector_performance"]
ORACLE["run_accounting"] = _sql(BRONZE, """
SELECT (SELECT count(*) FROM ing WHERE st IN ('ok', 'rejected', 'skipped')) AS documents,
       (SELECT count(*) FROM ing WHERE st = 'skipped') AS skipped_documents,
       (SELECT count(*) FROM ing WHERE st = 'rejected') AS rejected_documents,
       (SELECT count(*) FROM frows) AS parsed_days,
       (SELECT count(*) FROM pf p JOIN ing i ON p.ticker = i.ticker AND p.q = i.q WHERE i.st = 'ok'
         AND fault IN ('abc_close', 'null_high', 'not_object', 'decimal_volume', 'nan_low')) AS rejected_days,
       (SELECT count(*) FROM frows) - (SELECT count(*) FROM crow) AS dropped_rows,
       (SELECT count(*) FROM crow) AS clean_rows,
       (SELECT count(*) FROM srow) AS final_rows""")


def _dq_report_sql() -> str:
    # Required columns per model, as the oracle CTEs name them.
    checks = [
        ("stock_prices", "bars", [("ticker", "ticker"), ("trade_date", "trade_date"),
                                  ("open_price", "o"), ("close_price", "c")]),
        ("fct_daily_trading", "daily", [("ticker", "ticker"), ("trade_date", "trade_date"),
                                        ("close_price", "c"), ("sector", "dsector")]),
        ("fct_sector_performance", "sec", [("sector", "sector"), ("trade_date", "trade_date"),
                                           ("stock_count", "stock_count")]),
        ("dim_stocks", "dim", [("ticker", "ticker"), ("company_name", "company_name"),
                               ("sector", "sector")]),
    ]
    parts = []
    for model, cte, cols in checks:
        for name, expr in cols:
            parts.append(f"SELECT 'not_null' AS check_name, '{model}.{name}' AS target, "
                         f"count(*) FILTER (WHERE {expr} IS NULL) AS failures FROM {cte}")
    parts += [
        "SELECT 'unique', 'dim_stocks.ticker', count(*) FROM "
        "(SELECT ticker FROM dim GROUP BY ticker HAVING count(*) > 1)",
        "SELECT 'accepted_values', 'fct_daily_trading.sector', count(*) FROM daily "
        "WHERE dsector IS NOT NULL AND dsector NOT IN "
        "('Technology', 'Financials', 'Healthcare', 'Energy', 'Consumer Staples')",
        "SELECT 'return_range', 'fct_daily_trading.daily_return', count(*) FROM daily "
        "WHERE rm IS NOT NULL AND abs(rm) > 500000",
    ]
    body = "\nUNION ALL\n".join(parts)
    return _sql(SECTOR + """,
chk AS (""" + body + """),
fr AS (SELECT date_diff('second', max(CAST(trade_date AS TIMESTAMP) + INTERVAL 30 HOUR),
                        TIMESTAMP '2001-11-06 12:00:00') AS age FROM bars)""", """
SELECT check_name, target, CAST(failures AS BIGINT) AS failures,
       CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM chk
UNION ALL
SELECT 'freshness', 'stock_prices.processed_at',
       CAST(CASE WHEN age > 24 * 3600 THEN 1 ELSE 0 END AS BIGINT),
       CASE WHEN age > 48 * 3600 THEN 'error' WHEN age > 24 * 3600 THEN 'warn' ELSE 'pass' END
FROM fr""")


ORACLE["dq_report"] = _dq_report_sql()
