"""Keys, groups and order under a collation (S18; JN1-JN3, AG8, ST1).

By default text is compared byte by byte. Under a collation such as ``UNICODE_CI_AI`` spellings that differ in case or
accents only (``Bikes``, ``BIKES``, ``bikés``) are one value: one group, one join key, one place in the order. Every
class shows one spelling, the smallest in code-point order, so results do not depend on which row comes first.

``one_spelling`` finds the classes with a partial aggregate (a row per class leaves a task) and joins them back;
Spark compares collated keys by their collation keys in joins and by a collation-aware hash in shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from starbeam.plans.star import Star

_CLASS, _SHOWN = "_spelling_class", "_spelling_shown"


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def spellings(df: DataFrame, column: str, collation: str) -> DataFrame:
    """(class, shown): one row per class of equal spellings of ``column``, with its smallest spelling."""
    plain = F.collate(F.col(column), "UTF8_BINARY")
    classes = df.where(F.col(column).isNotNull()).groupBy(F.collate(F.col(column), collation).alias(_CLASS))
    return classes.agg(F.min(plain).alias(_SHOWN))


def one_spelling(df: DataFrame, columns: Sequence[str], collation: str, known: DataFrame | None = None) -> DataFrame:
    """``df`` with each of ``columns`` in the one spelling of its class and of the collated type, so that later joins, groups
    and orders follow the collation. ``known`` (of ``spellings``) gives the classes; a text in none of them stays. Nulls stay."""
    out = df
    for c in columns:
        classes = known if known is not None else spellings(df, c, collation)
        joined = out.join(classes, F.collate(out[c], collation) == classes[_CLASS], "left")
        shown = F.coalesce(F.collate(F.col(_SHOWN), "UTF8_BINARY"), F.collate(F.col(c), "UTF8_BINARY"))
        out = joined.withColumn(c, F.collate(shown, collation)).drop(_CLASS, _SHOWN)
    return out.select(*df.columns)


def _unique(dim: DataFrame, key: str, collation: str) -> DataFrame:
    """A dimension with one row per class of its text key: that of the smallest spelling. Rows without a key stay."""
    if key not in _text_columns(dim):
        return dim
    shown = spellings(dim, key, collation).select(_SHOWN)
    kept = dim.join(shown, F.collate(dim[key], "UTF8_BINARY") == F.collate(F.col(_SHOWN), "UTF8_BINARY"), "left_semi")
    return kept.unionByName(dim.where(F.col(key).isNull()))


def collated_star(star: Star, collation: str) -> Star:
    """The star with the text of its dimensions under ``collation``. Dimension rows whose keys become equal count as one (the smallest
    spelling); the fact's text keys take the dimension's spelling, so every query and report runs on it unchanged."""
    parts = {}
    fact, lines = star.fact, star.lines
    for name, key, of_fact in (("customers", "cst_id", "sls_cust_id"), ("products", "prd_key", "sls_prd_key")):
        dim = _unique(getattr(star, name), key, collation)
        if key in _text_columns(dim):
            known = spellings(dim, key, collation)
            fact = one_spelling(fact, [of_fact], collation, known)
            lines = one_spelling(lines, [of_fact], collation, known) if of_fact in lines.columns else lines
        parts[name] = one_spelling(dim, _text_columns(dim), collation)
    return replace(star, fact=fact, lines=lines, **parts)
