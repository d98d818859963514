"""Date helpers: tolerant parsing, month and year differences, age."""

from __future__ import annotations

import datetime as dt

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starbeam.config import DATE_FORMATS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_date(d: dt.date | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(d)


# A text that a pattern cannot read costs an exception, many times the price of a date: only texts in the shape of
# the pattern, with a month and a day that some date has, are given to the parser.
_DAY, _MONTH = "0[1-9]|[12][0-9]|3[01]", "0[1-9]|1[0-2]"
_COMPACT = rf"^[0-9]{{4}}({_MONTH})({_DAY})(\.0*)?\z"
_FIELDS = {"yyyy": "[+-]?[0-9]{4,}", "M": "0*([1-9]|1[0-2])", "d": "0*([1-9]|[12][0-9]|3[01])"}


def _shaped(text: Column, pattern: str) -> Column:
    """``text`` where it can be a date of ``pattern`` (fields of ``_FIELDS`` between slashes), else null."""
    fields = [_FIELDS.get(f) for f in pattern.split("/")]
    return text if None in fields else F.when(text.rlike(f"^{'/'.join(fields)}$"), text)


def parse_yyyymmdd(c: Column | str) -> Column:
    """Integer or text ``yyyymmdd`` (also ``20110101.0``) to DATE; anything else (``0``, bad day) is null."""
    text = F.trim(_col(c).cast("string"))
    iso = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(text.rlike(_COMPACT), iso.try_cast("date"))


def parse_date(c: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Free-form date or timestamp text to DATE: ISO forms, then ``formats`` in order; invalid is null."""
    text = F.trim(_col(c).cast("string"))
    return F.coalesce(F.try_to_timestamp(text).cast("date"), *[F.try_to_date(_shaped(text, f), f) for f in formats])


# Day and month as numbers in either order, then the year, with one kind of sign between them.
_NUMBERS = {
    "day": r"^(0?[1-9]|[12][0-9]|3[01])([/.\-])(0?[1-9]|1[0-2])\2([0-9]{4})\z",
    "month": r"^(0?[1-9]|1[0-2])([/.\-])(0?[1-9]|[12][0-9]|3[01])\2([0-9]{4})\z",
}
_ISO = {"day": "$4-$3-$1", "month": "$4-$1-$3"}


def parse_numbers(c: Column | str, form: Column | str) -> Column:
    """``31/12/2012`` (also with points or hyphens) to DATE, read day-first or month-first; anything else is null."""
    text = F.trim(_col(c).cast("string"))
    by_day, by_month = (F.when(text.rlike(_NUMBERS[f]), F.regexp_replace(text, _NUMBERS[f], _ISO[f]).try_cast("date")) for f in ("day", "month"))
    if isinstance(form, str):
        return by_day if form == "day" else by_month
    return F.when(form == "day", by_day).otherwise(by_month)


def parse_in_form(c: Column | str, form: Column | str) -> Column:
    """Date or timestamp text to DATE: year-first forms, then numbers in the column's ``form`` (``day`` or ``month``)."""
    return F.coalesce(parse_date(c, ("yyyy/M/d",)), parse_numbers(c, form))


def calendar_months(later: Column | str, earlier: Column | str) -> Column:
    """Calendar-month distance: (year * 12 + month) of ``later`` minus ``earlier``.

    Days of month are ignored, so Jan 31 -> Feb 1 counts one month.
    """
    later, earlier = _col(later), _col(earlier)
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def calendar_months_clipped(later: Column | str, earlier: Column | str) -> Column:
    """``calendar_months`` clipped at zero (lifespan)."""
    return F.greatest(calendar_months(later, earlier), F.lit(0))


def full_months(start: Column | str, end: Column | str) -> Column:
    """Completed months from ``start`` to ``end`` (Jan 31 -> Feb 28 is 0)."""
    return F.timestamp_diff("MONTH", _col(start), _col(end))


def full_years(start: Column | str, end: Column | str | dt.date) -> Column:
    """Completed years from ``start`` to ``end``."""
    return F.timestamp_diff("YEAR", _col(start), _lit_date(end) if not isinstance(end, str) else F.col(end))


def age_years(birthdate: Column | str, as_of: dt.date) -> Column:
    """Age as days / 365.25 rounded half-even to a whole number; null birthdate -> null."""
    days = F.datediff(F.lit(as_of), _col(birthdate))
    return F.bround(days / F.lit(365.25), 0).cast("int")


def not_after(c: Column | str, as_of: dt.date) -> Column:
    """Keep a date only when it is not later than ``as_of`` (future dates -> null)."""
    c = _col(c)
    return F.when(c <= F.lit(as_of), c)
