"""Exact decimal helpers.

Prices are ``decimal(12,4)`` from silver on, returns and volatility
``decimal(18,6)``. Averages are computed as an exact decimal sum divided by a
count and rounded half up once, so the values do not depend on the engine's
floating-point summation order.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

PRICE_TYPE = DecimalType(12, 4)
RETURN_TYPE = DecimalType(18, 6)


def half_up_ratio(num: Column, den: Column, scale: int) -> Column:
    """``num / den`` rounded half up to ``scale`` places; NULL if ``den`` is 0 or NULL.

    Inputs must be exact (decimal or integral). ``try_divide`` keeps ANSI mode
    from raising on a zero divisor.
    """
    return F.round(F.try_divide(num, den), scale)


def micro_units(col: Column, scale: int = 6) -> Column:
    """A decimal with ``scale`` places as an integral ``decimal(20,0)`` count of units."""
    return (col * F.lit(Decimal(10) ** scale)).cast(DecimalType(20, 0))


def from_micro_units(col: Column, scale: int = 6, precision: int = 18) -> Column:
    """Inverse of :func:`micro_units`."""
    return (col.cast(DecimalType(precision, 0)) * F.lit(Decimal(1).scaleb(-scale))).cast(
        DecimalType(precision, scale))


def packed_order_key(parts: list[tuple[Column, int]], value: Column, value_digits: int) -> Column:
    """Order-preserving ``decimal(38,0)`` key: non-negative integers, then a value.

    ``parts`` are (column, digits) pairs, most significant first; ``value``
    is an integral column whose absolute value has at most ``value_digits``
    digits (it is shifted to be non-negative). Comparing keys compares the
    tuples lexicographically, so ``min``/``max`` of the key find the first /
    last row of a sequence while the aggregation keeps fixed-width buffers
    (hash aggregate) instead of struct orderings (sort aggregate). A part
    outside its digit budget raises instead of mixing up the order.
    """
    total = sum(d for _, d in parts) + value_digits + 1
    if total > 38:
        raise ValueError(f"packed key needs {total} digits, decimal(38,0) holds 38")
    key = None
    ok = None
    for col, digits in parts:
        c = col.cast(DecimalType(38, 0))
        fits = (col >= 0) & (col < F.lit(Decimal(10) ** digits))
        ok = fits if ok is None else ok & fits
        key = c if key is None else key * F.lit(Decimal(10) ** digits) + c
    shift = Decimal(10) ** value_digits - 1
    v = (value.cast(DecimalType(38, 0)) + F.lit(shift))
    key = (key * F.lit(Decimal(10) ** (value_digits + 1)) + v).cast(DecimalType(38, 0))
    return F.when(ok | ok.isNull(), key).otherwise(
        F.raise_error(F.lit("packed_order_key: a part is outside its digit budget")))


def unpack_value(key: Column, value_digits: int) -> Column:
    """The value part of a :func:`packed_order_key` (inverse of the shift)."""
    base = F.lit(Decimal(10) ** (value_digits + 1))
    shift = F.lit(Decimal(10) ** value_digits - 1)
    return (F.pmod(key, base) - shift).cast(DecimalType(38, 0))
