"""Keep-latest / keep-first deduplication and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbeam.session import ensure_checkpoint_dir


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (which should end in a unique
    tie-break). The ``rn = 1`` filter lets Spark put a partial WindowGroupLimit
    before the shuffle, so a hot key sends at most one row per map task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def surrogate_key(df: DataFrame, order: Sequence[Column], name: str, partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1..n in ``order`` (a total order), without a single-task window.

    Range-partition and sort by ``order``, cut lineage with a reliable checkpoint
    (the partitions' contents are then fixed, also when a task is retried on another
    executor), count rows per partition (one row per partition, broadcast), and add
    each partition's offset to the row position.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # Without an explicit count AQE sizes the range partitions from the data and
    # may merge neighbours, which keeps them in key order.
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ordered = ranged.sortWithinPartitions(*order).checkpoint(eager=True)
    pos = ordered.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"),
    )
    keyed = pos.join(F.broadcast(offsets), "_pid")
    key = F.col("_offset") + (F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)) + 1
    return keyed.select(key.alias(name), *[F.col(c) for c in df.columns])
