"""Staging layer: normalise, type and lightly clean the landed price rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barlake.functions.numeric import PRICE_TYPE

PRICE_COLUMNS = ("open_price", "high_price", "low_price", "close_price")


def _price(of: str) -> str:
    return f"CAST({of} AS {PRICE_TYPE.simpleString()})"


#: Staged column -> expression over the landed row; the DataFrame and the catalog's view are both made of it.
EXPRESSIONS = {
    "ticker": "upper(trim(ticker))",
    "trade_date": "trade_date",
    **{c: _price(c) for c in PRICE_COLUMNS},
    "volume": "CAST(volume AS BIGINT)",
    "daily_range": _price(f"{_price('high_price')} - {_price('low_price')}"),
    "data_source": "source",
    "ingested_at": "ingested_at",
    "processed_at": "processed_at",
}
KEPT = "trade_date IS NOT NULL AND close_price > 0"


def stage_prices(raw: DataFrame) -> DataFrame:
    """Staging projection and filter over raw price rows.

    * ticker upper-cased and trimmed, prices exact at 4 places
    * ``daily_range`` = high - low at 4 places
    * ``source`` renamed ``data_source``
    * only rows with a trade date and a positive close are kept
    """
    return raw.where(KEPT).selectExpr(*[f"{e} AS {name}" for name, e in EXPRESSIONS.items()])


def staging_view(table: str) -> str:
    """The same as SQL over a table of the catalog."""
    return f"SELECT {', '.join(f'{e} AS {name}' for name, e in EXPRESSIONS.items())} FROM {table} WHERE {KEPT}"
