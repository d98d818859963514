"""Star joins: the fact is aggregated to the join key first, at every size.

The shuffle then carries at most one row per key and map task instead of one per
sale (a hot key collapses before the shuffle), the dimension's text columns never
cross it with the sales, and the join has one row per key on both sides. No side is
forced to be broadcast and nothing is measured while the plan is built: adaptive
execution broadcasts a side when the size of its shuffle shows that it is small, and
otherwise runs the sort-merge join with its skew split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """An aggregate over a fact column: sum, count, min, max or count_distinct."""

    name: str
    kind: str
    column: str


_PARTIAL = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def rollup_over_dimension(
    fact: DataFrame,
    fact_key: str,
    dim: DataFrame,
    dim_key: str,
    by: Sequence[str],
    measures: Sequence[Measure],
    how: str = "left",
    fact_by: Sequence[tuple[str, Column]] = (),
) -> DataFrame:
    """``SELECT fact_by, by, measures FROM fact {how} JOIN dim GROUP BY fact_by, by``.

    ``by`` are dimension columns (null for unmatched facts in a left join, which
    then form one group, as in SQL). ``fact_by`` are (name, expression) pairs on
    the fact. The fact is aggregated per join key (and per distinct-counted
    columns), joined, and aggregated to the result's groups.
    """
    fact_by = list(fact_by)
    if fact_by:
        fact = fact.withColumns(dict(fact_by))
    names = [name for name, _ in fact_by]
    dim = dim.select(dim_key, *[c for c in by if c != dim_key])
    distinct = sorted({m.column for m in measures if m.kind == "count_distinct"})
    partials = [_PARTIAL[m.kind](m.column).alias(f"_part{i}") for i, m in enumerate(measures) if m.kind != "count_distinct"]
    finals = [
        (F.count_distinct(m.column) if m.kind == "count_distinct" else _MERGE[m.kind](f"_part{i}")).alias(m.name)
        for i, m in enumerate(measures)
    ]
    keyed = fact.groupBy(fact_key, *names, *distinct)
    per_key = keyed.agg(*partials) if partials else fact.select(fact_key, *names, *distinct).distinct()
    joined = per_key.join(dim, per_key[fact_key] == dim[dim_key], how)
    return joined.groupBy(*names, *by).agg(*finals)


#: Keys that the sketch tracks; a key above ``HOT_SHARE`` of the rows is among them whatever the data.
TRACKED, HOT_SHARE, SALTS = 4096, 0.002, 64


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, tracked: int = TRACKED) -> DataFrame:
    """(_hot): keys that about ``share`` of the rows or more have, at most ``1 / share`` of them and some near it:
    a frequent-items sketch of ``tracked`` counters, merged over the tasks. Null keys join nothing and are not counted."""
    most = int(1 / share)
    top = df.where(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("_n"), F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("_top"))
    return top.select("_n", F.explode("_top").alias("_t")).where(F.col("_t.count") >= F.col("_n") * share).select(F.col("_t.item").alias("_hot"))


def salted_left_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, salts: int = SALTS, share: float = HOT_SHARE, deal_by: Sequence[str] | None = None) -> DataFrame:
    """``fact LEFT JOIN dim`` on the keys, row by row, for joins that cannot be aggregated first.

    Rows of a hot key are dealt to ``salts`` groups by the hash of the whole row (or of its columns ``deal_by``, where
    the others are not needed) and its input partition (the same on a retry), the dimension's rows of hot keys are copied to each of them, and rows of other keys
    are joined plainly in the same exchange. The hot keys, at most ``1 / share``, are broadcast; the dimension
    never is by force. Whether a key counts as hot changes the plan's balance only, never the result.
    """
    hot = F.broadcast(hot_keys(fact, fact_key, share))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in deal_by or fact.columns], F.spark_partition_id()), F.lit(salts)).cast("int")
    left = fact.withColumn("_salt", salt).join(hot, F.col(fact_key) == F.col("_hot"), "left").withColumn("_salt", F.when(F.col("_hot").isNotNull(), F.col("_salt")).otherwise(F.lit(0))).drop("_hot")
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = dim.join(hot, F.col(dim_key) == F.col("_hot"), "left").withColumn("_salt_d", F.explode(copies)).drop("_hot")
    return left.join(right, (left[fact_key] == right[dim_key]) & (left["_salt"] == right["_salt_d"]), "left").drop("_salt", "_salt_d")
