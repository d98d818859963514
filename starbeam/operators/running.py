"""Windows over all rows in one order (WN3-WN8 without PARTITION BY), in many tasks.

``SUM(x) OVER (ORDER BY k)`` puts every row into one task. Here the rows are range-partitioned and sorted by
``k`` and the partitions fixed by a checkpoint; a row per partition holds its sums and its number of rows; a
prefix scan over these rows gives each partition what comes before it, and the windows run inside partitions.
Rows that a lookback of ``r`` rows needs across a border (rolling frames, lag) are copied to the partitions
after: at most ``r`` rows a border, however few rows a partition in between has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbeam.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Over:
    """One window column: ``sum``, ``avg`` or ``count`` of ``column`` over all rows up to this one, or over the
    last ``rows`` rows with this one; ``lag`` is its value ``rows`` (1 by default) rows before."""

    name: str
    kind: str
    column: str
    rows: int | None = None

    @property
    def lookback(self) -> int:
        return (self.rows or 1) if self.kind == "lag" else (self.rows - 1 if self.rows else 0)


def _mean(total: Column, n: Column) -> Column:
    return F.try_divide(total.cast("double"), n)


def running_over(df: DataFrame, order: Sequence[Column], columns: Sequence[Over], partitions: int | None = None) -> DataFrame:
    """``df`` with the window ``columns``, in ROWS frames over ``order``, which must be total for a defined result.

    Nulls are skipped and a frame of nulls only gives null (count 0), as in SQL. Sums of DECIMAL and integer
    columns are exact; ``avg`` is a DOUBLE, the exact sum divided by the count.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    fixed = ranged.sortWithinPartitions(*order).checkpoint(eager=True)
    rows = fixed.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    running = sorted({c.column for c in columns if c.kind != "lag" and not c.rows})
    reach = max([c.lookback for c in columns], default=0)

    # one row per partition: rows and sums before it, and the partitions that look back into it
    own = rows.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in running], *[F.count(c).alias(f"_count_{c}") for c in running]
    )
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = own.select(
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        *[F.sum(f"_{kind}_{c}").over(before).alias(f"_before_{kind}_{c}") for c in running for kind in ("sum", "count")],
    )
    if reach:
        after = F.collect_list(F.struct(F.col("_pid").alias("pid"), F.col("_offset").alias("offset"))).over(Window.orderBy("_pid").rowsBetween(1, reach))
        spans = spans.withColumn("_after", after)
    spans = F.broadcast(spans)  # a row per partition

    position = F.col("_offset") + (F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33))
    placed = rows.join(spans.drop(*[c for c in spans.columns if c.startswith("_before")]), "_pid").withColumn("_at", position)
    if reach:
        needed = F.filter("_after", lambda a: F.col("_at") >= a["offset"] - reach)
        placed = placed.withColumn("_to", F.explode(F.concat(F.array("_pid"), F.transform(needed, lambda a: a["pid"])))).drop("_after")
    else:
        placed = placed.withColumn("_to", F.col("_pid"))
    home = F.col("_to") == F.col("_pid")
    here = Window.partitionBy("_to").orderBy("_at")
    up_to = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exprs = {}
    for c in running:  # copies from earlier partitions are already in the sums before
        exprs[f"_here_sum_{c}"] = F.sum(F.when(home, F.col(c))).over(up_to)
        exprs[f"_here_count_{c}"] = F.count(F.when(home, F.col(c))).over(up_to)
    for c in columns:
        if c.kind == "lag":
            exprs[c.name] = F.lag(c.column, c.rows or 1).over(here)
        elif c.rows:
            frame = here.rowsBetween(1 - c.rows, Window.currentRow)
            total, n = F.sum(c.column).over(frame), F.count(c.column).over(frame)
            exprs[c.name] = {"sum": total, "count": n, "avg": _mean(total, n)}[c.kind]
    out = placed.withColumns(exprs).where(home)
    if running:
        out = out.join(spans.select("_pid", *[c for c in spans.columns if c.startswith("_before")]), "_pid")
    finals = []
    for c in columns:
        if c.kind == "lag" or c.rows:
            finals.append(F.col(c.name))
            continue
        s, b = F.col(f"_here_sum_{c.column}"), F.col(f"_before_sum_{c.column}")
        total = F.coalesce(s + b, s, b)
        n = F.col(f"_here_count_{c.column}") + F.coalesce(F.col(f"_before_count_{c.column}"), F.lit(0))
        finals.append({"sum": total, "count": n, "avg": _mean(total, n)}[c.kind].alias(c.name))
    return out.select(*df.columns, *finals)
