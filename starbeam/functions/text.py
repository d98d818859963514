"""Text column helpers: whitespace strip, code recoding, key normalising, splitting."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed by a full strip (space, tab, newline, carriage return, form
# feed, vertical tab) — wider than SQL TRIM, which removes spaces only.
WHITESPACE = " \t\n\r\f\v"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of every kind."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def upper_strip(c: Column | str) -> Column:
    return F.upper(strip(c))


def lookup(key: Column, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Map ``key`` through a small fixed table; unmatched keys give ``default``.

    A CASE chain on literals: stays inside whole-stage codegen, no per-row map.
    """
    out = None
    for k, v in mapping.items():
        out = F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v))
    if out is None:
        return default if default is not None else key
    return out.otherwise(default) if default is not None else out


def recode(c: Column | str, mapping: Mapping[str, str], null_codes: Iterable[str] = ()) -> Column:
    """Upper-case and strip a code, map it, null the ``null_codes``.

    Codes that are neither mapped nor null codes pass through upper-cased.
    """
    key = upper_strip(c)
    mapped = lookup(key, mapping, default=key)
    null_codes = list(null_codes)
    if null_codes:
        mapped = F.when(key.isin(null_codes), F.lit(None).cast("string")).otherwise(mapped)
    return mapped


def fill_text(c: Column | str, filler: str) -> Column:
    """Missing text becomes ``filler``; then strip."""
    return strip(F.coalesce(_col(c), F.lit(filler)))


def remove_prefix_token(c: Column | str, token: str) -> Column:
    """Key normaliser: text form, every ``token`` removed, stripped (e.g. ``NAS00042``)."""
    return strip(F.replace(_col(c).cast("string"), F.lit(token), F.lit("")))


def split_segments(c: Column | str, sep: str = "-") -> Column:
    """Split a compound key into its segments (array of strings)."""
    return F.split(_col(c), _regex_quote(sep))


def join_segments(parts: Column, start: int, stop: int | None, sep: str) -> Column:
    """Join segments ``start`` (0-based) up to ``stop`` (exclusive, None = all)."""
    length = (F.size(parts) - F.lit(start)) if stop is None else F.lit(stop - start)
    sliced = F.slice(parts, F.lit(start + 1), F.greatest(length, F.lit(0)))
    return F.array_join(sliced, sep)


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\-" else ch for ch in s)
