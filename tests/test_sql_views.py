"""SRC5: SQL text over the star's views, checked against DataFrame answers and against sums by hand."""

import pytest
from pyspark.sql import functions as F

from starbeam.plans.table_store import read_table
from starbeam.config import FIXTURE
from starbeam.operators.reports import report_customers
from starbeam.plans import warehouse
from starbeam.sources import testdata


@pytest.fixture(scope="module")
def star_views(spark, sf_small):
    star = testdata.star(spark, sf_small)
    names = warehouse.register_views(star, {"report_customers": report_customers(star, FIXTURE)})
    assert {"fact_sales", "dim_customers", "dim_products", "dim_date", "report_customers"} <= set(names)
    return star


def test_weekend_share_of_order_lines(spark, star_views):
    got = spark.sql("""
        WITH lines AS (SELECT dim_date.is_weekend AS weekend FROM fact_sales INNER JOIN dim_date ON sls_order_dt = date)
        SELECT count_if(weekend) AS on_weekend, count(*) AS all_lines FROM lines""").first()
    dated = star_views.fact.where("sls_order_dt IS NOT NULL")
    assert got.all_lines == dated.count()
    assert got.on_weekend == dated.where(F.dayofweek("sls_order_dt").isin(1, 7)).count()


def test_days_to_ship(spark, star_views):
    got = spark.sql("SELECT avg(datediff(sls_ship_dt, sls_order_dt)) FROM fact_sales").first()[0]
    want = star_views.fact.agg(F.avg(F.datediff("sls_ship_dt", "sls_order_dt"))).first()[0]
    assert got == want


def test_customers_above_their_country_mean(spark, star_views):
    got = spark.sql("""
        WITH mean_of AS (SELECT cntry AS land, avg(total_sales) AS mean FROM report_customers GROUP BY cntry)
        SELECT count(*) FROM report_customers JOIN mean_of ON cntry <=> land WHERE total_sales > mean""").first()[0]
    rows = report_customers(star_views, FIXTURE).select("cntry", "total_sales").toPandas()
    assert got == int((rows.total_sales > rows.groupby("cntry", dropna=False).total_sales.transform("mean")).sum())


def test_products_never_sold(spark, star_views):
    got = spark.sql("SELECT prd_key FROM dim_products EXCEPT SELECT sls_prd_key FROM fact_sales").count()
    sold = star_views.fact.select("sls_prd_key").distinct()
    assert got == star_views.products.join(sold, star_views.products["prd_key"] == sold["sls_prd_key"], "left_anti").count()


def test_command_line_writes_the_whole_sql_result(spark, sf_small, tmp_path):
    from starbeam.__main__ import main

    out, result = str(tmp_path / "wh"), str(tmp_path / "result")
    assert main(["--source", "testdata", "--sf-dir", sf_small, "--out", out]) == 0
    assert main(["--out", out, "--no-build", "--sql", "SELECT sls_ord_num FROM fact_sales", "--sql-out", result]) == 0
    assert spark.read.parquet(result).count() == read_table(spark, f"{out}/gold/fact_sales").count() > 50
