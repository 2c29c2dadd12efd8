"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_whitespace(col: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (tabs, newlines too).

    SQL ``trim`` only strips spaces; the landing code normalises with a
    whitespace-class strip, so the regex form is used there. ``(?U)`` makes
    the whitespace class match Unicode spaces too (no-break space and the like).
    """
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def normalise_ticker(col: Column) -> Column:
    """Upper-cased ticker without surrounding whitespace."""
    return F.upper(strip_whitespace(col))


def parse_ticker_list(text: str) -> list[str]:
    """A comma-separated ticker parameter as a clean list (empty items dropped)."""
    return [t.strip().upper() for t in text.split(",") if t.strip()]

