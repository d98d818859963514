"""Numeric helpers: tolerant casts, money, rounding, safe division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# Silver and gold keep what the source gives; only results are rounded.
QUANTITY = "decimal(18,4)"
PRICE = "decimal(18,4)"
AMOUNT = "decimal(20,4)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_integer(c: Column | str) -> Column:
    """Text or number to BIGINT, digit by digit (no float in between, so ids above 2^53
    stay apart). ``'11000.0'`` -> 11000; non-integral, too large or bad -> null."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]+(\.0*)?$"), F.substring_index(text, ".", 1).try_cast("bigint"))


def half_even(c: Column | str, digits: int) -> Column:
    """Banker's rounding (the report layer's rule)."""
    return F.bround(_col(c), digits)


def ratio_or(num: Column | str, den: Column | str, fallback: Column) -> Column:
    """``num / den``; a zero or missing divisor gives ``fallback``."""
    num, den = _col(num), _col(den)
    return F.when(den.isNull() | (den == 0), fallback).otherwise(F.try_divide(num, den))
