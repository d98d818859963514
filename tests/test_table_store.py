"""A table is replaced as a whole or stays as it was."""

import os

import pytest
from pyspark.sql import functions as F

from starbeam.config import FIXTURE
from starbeam.plans.table_store import current_version, read_table, replace_table
from starbeam.plans.warehouse import Warehouse


def failing(spark, rows):
    """A table whose last partition fails while the others are being written."""
    return spark.range(rows, numPartitions=4).withColumn("x", F.when(F.col("id") == rows - 1, F.raise_error(F.lit("boom"))).otherwise(F.lit("new")))


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark, path, spark.range(10).withColumn("x", F.lit("old")))
    before = current_version(spark, path)
    with pytest.raises(Exception, match="boom"):
        replace_table(spark, path, failing(spark, 1000))
    assert current_version(spark, path) == before
    assert read_table(spark, path).groupBy("x").count().collect() == [("old", 10)]
    replace_table(spark, path, spark.range(3).withColumn("x", F.lit("new")))
    assert read_table(spark, path).count() == 3


def test_a_failed_first_write_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="boom"):
        replace_table(spark, path, failing(spark, 100))
    assert current_version(spark, path) is None


def test_a_table_may_be_made_from_itself_and_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    held = replace_table(spark, path, spark.range(5))
    for n in range(1, 5):
        replace_table(spark, path, read_table(spark, path).withColumn("id", F.col("id") + 1), None)
        if n == 1:
            assert held.count() == 5  # a reader of the version before
    assert sorted(r.id for r in read_table(spark, path).collect()) == [4, 5, 6, 7, 8]
    assert len([f for f in os.listdir(path) if f.startswith("v-")]) == 2


def test_warehouse_keeps_a_partitioned_table(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), FIXTURE)
    wh.write("gold", "t", spark.range(10).withColumn("y", F.col("id") % 2), partition_by="y")
    with pytest.raises(Exception, match="boom"):
        wh.write("gold", "t", failing(spark, 100).withColumn("y", F.lit(1)), partition_by="y")
    assert read_table(spark, wh.path("gold", "t")).where("y = 1").count() == 5
