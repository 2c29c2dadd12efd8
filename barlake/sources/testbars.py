"""Daily bars derived from the TPC-H-style harness tables.

The harness has no price table, so one is derived: every nation is an
entity ("ticker"), its region the sector, and the nation's line items on a
ship date the trades of one day:

* ticker = nation name, sector = region name
* trade_date = ship date as DATE, price = extended price as decimal(12,2)
* open / close = price of the first / last trade in (order key, line number,
  price) order, high / low = max / min price, volume = total quantity.

The (order key, line number) pair is not unique in the test data, so the
price itself is the last ordering column; then ties carry equal prices and
the bar is fully determined.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from barlake.functions.numeric import packed_order_key, unpack_value

BAR_PRICE_TYPE = DecimalType(12, 2)


# Declared schemas of the harness tables this build reads (no footer inference).
TABLE_SCHEMAS = {
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
               "value double, props string"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A harness table; with a declared schema when known, so no footer is read to plan."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def geography(nation: DataFrame, region: DataFrame) -> DataFrame:
    """(n_nationkey, ticker, sector): nation joined to its region (both tiny tables;
    the planner broadcasts one by its own size estimate)."""
    return (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey"), F.col("n_name").alias("ticker"),
                    F.col("r_name").alias("sector")))


def daily_bars(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame,
               region: DataFrame) -> DataFrame:
    """OHLCV bars per (ticker, sector, trade_date).

    Plan: line items join the supplier -> nation mapping (the planner
    broadcasts it while its size is under the broadcast threshold -- 10,000
    suppliers per scale factor -- and switches to a sort-merge join beyond),
    are grouped by the
    integer (nation key, date) with a partial hash aggregate before the
    shuffle -- each map task sends at most one row per group whatever the
    skew -- and only the aggregated bars are joined to the names.
    """
    supplier_map = supplier.select("s_suppkey", "s_nationkey")
    price = F.col("l_extendedprice").cast(BAR_PRICE_TYPE)
    trades = lineitem.select(
        F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_linenumber"),
        price.alias("price"), F.col("l_quantity"),
        F.col("l_shipdate").cast("date").alias("trade_date"))
    joined = trades.join(supplier_map, F.col("l_suppkey") == F.col("s_suppkey"))
    bars = ohlcv(joined, ["s_nationkey", "trade_date"],
                 [("l_orderkey", 19), ("l_linenumber", 6)], "price", "l_quantity")
    geo = geography(nation, region)  # 25 nations, 5 regions: fixed by the schema's spec
    return (bars.join(geo, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("ticker", "sector", "trade_date", "open_price", "high_price", "low_price",
                    "close_price", "volume"))


def ohlcv(trades: DataFrame, keys: list[str], sequence: list[tuple[str, int]], price: str,
          quantity: str) -> DataFrame:
    """Collapse trades into one bar per ``keys``.

    ``sequence`` orders the trades of a bar: non-negative integer columns
    with their digit budgets (the price is the last tie-break). Open and
    close are the prices of the first and last trade, found as min / max of
    an order-preserving packed key so the aggregate stays a hash aggregate.
    Trades without a price are ignored.
    """
    p = F.col(price)
    scale = trades.schema[price].dataType.scale
    units = (p * F.lit(Decimal(10) ** scale)).cast("decimal(38,0)")
    digits = trades.schema[price].dataType.precision
    key = packed_order_key([(F.col(c), d) for c, d in sequence], units, digits)
    ptype = trades.schema[price].dataType
    from_units = lambda k: (unpack_value(k, digits) / F.lit(Decimal(10) ** scale)).cast(ptype)
    agg = (trades.withColumn("_k", key)
           .groupBy(*keys).agg(
               F.min("_k").alias("_first"),
               F.max(p).alias("high_price"),
               F.min(p).alias("low_price"),
               F.max("_k").alias("_last"),
               F.sum(F.col(quantity).cast("decimal(20,0)")).cast("bigint").alias("volume")))
    return agg.select(*keys, from_units(F.col("_first")).alias("open_price"), "high_price",
                      "low_price", from_units(F.col("_last")).alias("close_price"), "volume")


def bars_for(spark: SparkSession, sf_dir: str, tickers: list[str] | None = None) -> DataFrame:
    """The bars of all tickers, or of some only: then suppliers of other nations are dropped
    before the line items are joined and aggregated."""
    t = lambda name: read_table(spark, sf_dir, name)
    nation = t("nation")
    if tickers is None:
        return daily_bars(t("lineitem"), t("supplier"), nation, t("region"))
    wanted = nation.where(F.col("n_name").isin(tickers))
    supplier = t("supplier").join(wanted.select(F.col("n_nationkey").alias("s_nationkey")), "s_nationkey", "left_semi")
    return daily_bars(t("lineitem"), supplier, wanted, t("region"))
