"""Windows over all rows in many tasks, mergeable distinct counts and the salted join, against the plain forms."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starbeam.operators.distinct import distinct_per_level, rollup_distinct
from starbeam.operators.joins import hot_keys, salted_left_join
from starbeam.operators.running import Over, running_over

COLUMNS = [Over("s", "sum", "x"), Over("a", "avg", "x"), Over("c", "count", "x"), Over("r3", "sum", "x", 3), Over("m5", "avg", "x", 5), Over("n2", "count", "x", 2), Over("l1", "lag", "x"), Over("l4", "lag", "x", 4)]


def plain(df):
    w = Window.orderBy("k")
    to = w.rowsBetween(Window.unboundedPreceding, 0)

    def mean(frame):
        return F.try_divide(F.sum("x").over(frame).cast("double"), F.count("x").over(frame))

    return df.select("*", F.sum("x").over(to).alias("s"), mean(to).alias("a"), F.count("x").over(to).alias("c"), F.sum("x").over(w.rowsBetween(-2, 0)).alias("r3"),
                     mean(w.rowsBetween(-4, 0)).alias("m5"), F.count("x").over(w.rowsBetween(-1, 0)).alias("n2"), F.lag("x").over(w).alias("l1"), F.lag("x", 4).over(w).alias("l4"))


@pytest.mark.parametrize("n,partitions", [(0, 4), (1, 4), (7, 6), (9, 40), (500, 7), (500, None)])
def test_running_over_equals_the_window(spark, n, partitions):
    """Also with partitions of fewer rows than the lookback, and empty ones."""
    rnd = random.Random(n)
    rows = [(i * 3 - 50, None if rnd.random() < 0.3 else Decimal(rnd.randint(-9999, 9999)) / 100) for i in range(n)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k bigint, x decimal(10,2)")
    got = running_over(df, [F.asc("k")], COLUMNS, partitions)
    want = plain(df)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=lambda r: r.k) == sorted(want.collect(), key=lambda r: r.k)


def test_running_over_has_no_single_task_over_rows(spark):
    df = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") % 97).alias("x"))
    out = running_over(df, [F.asc("k")], [Over("s", "sum", "x"), Over("r", "sum", "x", 10)], 8)
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    # what goes to one task is the sums of partitions
    assert single and all("HashAggregate" in lines[i + 1] for i in single)
    assert out.agg(F.max("s")).first()[0] == sum(i % 97 for i in range(100_000)) and out.count() == 100_000


def test_distinct_counts_merge(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([2020, 2021, None]), rnd.randint(1, 3), rnd.choice([None, 0, -5, rnd.randint(-70_000, 70_000), 7])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "y int, m int, k bigint")
    month, year = distinct_per_level(df, [["y", "m"], ["y"]], "k", "n")
    known = df.where("k IS NOT NULL")
    assert sorted(month.collect(), key=str) == sorted(known.groupBy("y", "m").agg(F.count_distinct("k").alias("n")).collect(), key=str)
    assert sorted(year.collect(), key=str) == sorted(known.groupBy("y").agg(F.count_distinct("k").alias("n")).collect(), key=str)
    rolled = {(r.level, r.y, r.m): r.n for r in rollup_distinct(df, ["y", "m"], "k", "n").collect()}
    assert rolled[(0, None, None)] == len({k for _, _, k in rows if k is not None})
    assert rolled[(1, None, None)] == len({k for y, _, k in rows if k is not None and y is None})
    assert rolled[(2, 2020, 1)] == len({k for y, m, k in rows if k is not None and (y, m) == (2020, 1)})
    assert rollup_distinct(df.limit(0), ["y", "m"], "k", "n").count() == 0


def test_salted_join_equals_the_join_and_spreads_the_hot_key(spark):
    fact = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 5000).alias("f"), F.col("id").alias("v"))
    dim = spark.range(4000).select(F.col("id").alias("d"), (F.col("id") * 2).alias("cost"))
    dim = dim.union(spark.createDataFrame([(8, 1), (None, 2)], "d bigint, cost bigint"))  # a repeated key and a null key
    got, want = salted_left_join(fact, dim, "f", "d"), fact.join(dim, fact["f"] == dim["d"], "left")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert 7 in {r[0] for r in hot_keys(fact, "f").collect()}
    assert salted_left_join(fact.limit(0), dim, "f", "d").count() == 0


def test_salted_join_deals_rows_evenly(spark):
    """One key on a third of the rows: no task of the join reads over twice the median (merging of partitions off)."""
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        fact = spark.range(0, 80_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_000).alias("f"), F.col("id").alias("v"))
        dim = spark.range(20_000).select(F.col("id").alias("d"), (F.col("id") * 2).alias("cost"))
        sizes = sorted(r["count"] for r in salted_left_join(fact, dim, "f", "d").groupBy(F.spark_partition_id().alias("p")).count().collect())
        plainly = sorted(r["count"] for r in fact.join(dim, fact["f"] == dim["d"], "left").groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert plainly[-1] > 3 * plainly[len(plainly) // 2]
    assert sum(sizes) == 80_000 and sizes[-1] < 2 * sizes[len(sizes) // 2]
