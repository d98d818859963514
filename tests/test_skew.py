"""A hot key holding about a third of all sales lines: results stay exact on both
join strategies, and the plans aggregate before any shuffle on that key."""

import pytest
from pyspark.sql import functions as F

from starbeam.config import FIXTURE
from starbeam.operators.joins import Measure, rollup_over_dimension
from starbeam.operators.keys import keep_first
from starbeam.operators.reports import report_customers
from starbeam.plans.star import Star
from starbeam.sources import testdata

HOT = 0


@pytest.fixture(scope="module")
def skewed(spark, sf_small):
    base = testdata.star(spark, sf_small)
    hot = F.when(F.col("sls_ord_num") % 3 == 0, F.lit(HOT).cast("bigint")).otherwise(F.col("sls_cust_id"))
    fact = base.fact.withColumn("sls_cust_id", hot)
    return Star(fact=fact, customers=base.customers, products=base.products)


def test_hot_key_holds_a_third(skewed):
    total = skewed.fact.count()
    hot = skewed.fact.where(F.col("sls_cust_id") == HOT).count()
    assert 0.28 < hot / total < 0.4


def test_rollup_exact_under_skew(skewed):
    measures = [Measure("revenue", "sum", "sales_amount"), Measure("orders", "count_distinct", "sls_ord_num")]
    got = rollup_over_dimension(skewed.fact, "sls_cust_id", skewed.customers, "cst_id",
                                ["cst_id", "cntry"], measures)
    j = skewed.fact.join(skewed.customers, skewed.fact["sls_cust_id"] == skewed.customers["cst_id"], "left")
    want = j.groupBy("cst_id", "cntry").agg(F.sum("sales_amount").alias("revenue"),
                                           F.count_distinct("sls_ord_num").alias("orders"))
    cols = ["cst_id", "cntry", "revenue", "orders"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_report_exact_under_skew(skewed):
    rep = report_customers(skewed, FIXTURE)
    hot = rep.where(F.col("cst_id") == HOT).first()
    brute = (skewed.fact.where((F.col("sls_cust_id") == HOT) & F.col("sls_order_dt").isNotNull())
             .agg(F.sum("sales_amount").cast("double").alias("s"), F.count_distinct("sls_ord_num").alias("o"))
             .first())
    assert hot["total_sales"] == brute["s"] and hot["total_orders"] == brute["o"]
    # every customer with a dated sale appears once
    n = skewed.fact.where(F.col("sls_order_dt").isNotNull()).select("sls_cust_id").distinct().count()
    assert rep.count() == n == rep.select("cst_id").distinct().count()


def test_report_aggregates_before_shuffling_on_the_hot_key(skewed):
    text = report_customers(skewed, FIXTURE)._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    on_key = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(sls_cust_id" in line]
    # every shuffle of sales on the key is fed by a partial aggregate (map-side combine)
    assert on_key and all("HashAggregate" in lines[i + 1] for i in on_key)


def test_keep_first_on_hot_key(spark):
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    out = keep_first(df, ["k"], [F.desc("v")])
    assert out.count() == df.select("k").distinct().count()
    assert out.where(F.col("k") == 0).first()["v"] == 29997
