"""Exact distinct counts that merge (AG4): bitmaps of integer keys.

A key is one bit of the bitmap of its bucket (32,768 keys a bucket), so the distinct keys of a group are
a few rows of 4 KB instead of one row per key, they are built in the tasks before the shuffle, and the
bitmaps of months merge to those of years: one scan serves every level. Meant for dense integer keys
(surrogate ids); for sparse ones a bucket of one key costs 4 KB and a plain distinct is better. Hot keys
are one bit. Null keys are not counted, as in COUNT(DISTINCT).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "_bucket", "_bits"


def key_bitmaps(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """(by, bucket, bits): the distinct integer ``key`` values of each group."""
    position = F.bitmap_bit_position(F.col(key))
    rows = df.where(F.col(key).isNotNull()).groupBy(*by, F.bitmap_bucket_number(F.col(key)).alias(BUCKET))
    return rows.agg(F.bitmap_construct_agg(position).alias(BITS))


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups: ``by`` is part of the grouping that they were built by."""
    return bitmaps.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_keys(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """(by, name): distinct keys per group. Groups that only have null keys have no row."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).alias(name))


def distinct_per_level(df: DataFrame, levels: Sequence[Sequence[str]], key: str, name: str) -> list[DataFrame]:
    """Distinct keys for each of ``levels``, the finest first, each a part of the one before; every level is
    merged from the one before it, so ``df`` is scanned once if the first level's bitmaps are cached or written."""
    bitmaps, out = key_bitmaps(df, levels[0], key), []
    for no, level in enumerate(levels):
        bitmaps = merge_bitmaps(bitmaps, level) if no else bitmaps
        out.append(count_keys(bitmaps, level, name))
    return out


def rollup_distinct(df: DataFrame, levels: Sequence[str], key: str, name: str) -> DataFrame:
    """ROLLUP(levels) with the distinct keys of each group and of all, from one scan: the bitmaps of the finest
    groups are counted for every prefix of ``levels`` (null in the columns that are rolled up, ``level`` = columns kept)."""
    finest = key_bitmaps(df, levels, key)
    kept = F.explode(F.sequence(F.lit(0), F.lit(len(levels)))).alias("level")
    spread = finest.select("*", kept)
    columns = [F.when(F.col("level") > i, F.col(c)).alias(c) for i, c in enumerate(levels)]
    merged = spread.select("level", *columns, BUCKET, BITS).groupBy("level", *levels, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
    return count_keys(merged, ["level", *levels], name)
