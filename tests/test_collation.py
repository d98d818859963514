"""Keys, groups and order under a collation, and byte by byte without one."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starbeam.config import FIXTURE
from starbeam.operators.collation import collated_star, one_spelling, spellings
from starbeam.operators import reports
from starbeam.plans import analytics, registry
from starbeam.plans.star import Star
from starbeam.sources import testdata

CI_AI = "UNICODE_CI_AI"


@pytest.fixture(scope="module")
def star(spark):
    day, amount = dt.date(2012, 1, 2), Decimal(10)
    fact = spark.createDataFrame([(str(i), key, 1, day, day, Decimal(1), amount, amount) for i, key in enumerate(["P1", "p1", "P2", "p3", "none"])],
                                 "sls_ord_num string, sls_prd_key string, sls_cust_id bigint, sls_order_dt date, sls_ship_dt date, sls_quantity decimal(18,4), sls_price decimal(18,2), sales_amount decimal(18,2)")
    customers = spark.createDataFrame([(1, "k", "Ann", "Lee", "F", "France", day)], "cst_id bigint, cst_key string, cst_firstname string, cst_lastname string, cst_gndr string, cntry string, bdate date")
    products = spark.createDataFrame([("p1", "a", "Bikes", "x", amount), ("P2", "b", "BIKES", "x", amount), ("p2", "b2", "cars", "x", amount), ("P3", "c", "bikés", None, amount), (None, "d", "Zoo", None, amount)],
                                     "prd_key string, prd_nm string, cat string, subcat string, prd_cost decimal(18,2)")
    return Star(fact=fact, customers=customers, products=products)


def test_spellings_that_differ_in_case_or_accents_are_one_group(star):
    plain = {r.category: r.total_revenue for r in analytics.q12_revenue_by_category(star, FIXTURE).collect()}
    assert plain == {"Bikes": 10.0, "BIKES": 10.0, None: 30.0}  # p1 and P2 match, the other keys do not
    under = {r.category: r.total_revenue for r in analytics.q12_revenue_by_category(collated_star(star, CI_AI), FIXTURE).collect()}
    assert under == {"BIKES": 40.0, None: 10.0}


def test_equal_keys_join_once(star):
    under = collated_star(star, CI_AI)
    assert sorted(str(r.prd_key) for r in under.products.collect()) == ["None", "P2", "P3", "p1"]  # p2 equals P2: the smaller one stays
    assert under.fact.count() == star.fact.count()
    assert sorted(r.sls_prd_key for r in under.fact.collect()) == ["P2", "P3", "none", "p1", "p1"]
    assert reports.report_products(under, FIXTURE).count() == 3


def test_order_follows_the_collation(spark):
    df = spark.createDataFrame([("b",), ("Z",), ("á",), ("C",), (None,)], "c string")
    assert [r.c for r in one_spelling(df, ["c"], CI_AI).orderBy(F.asc_nulls_last("c")).collect()] == ["á", "b", "C", "Z", None]
    assert [r.c for r in df.orderBy(F.asc_nulls_last("c")).collect()] == ["C", "Z", "b", "á", None]


def test_empty_tables_and_extra_columns(spark):
    df = spark.createDataFrame([], "c string, n int")
    assert one_spelling(df, ["c"], CI_AI).columns == ["c", "n"] and spellings(df, "c", CI_AI).count() == 0


def test_every_query_runs_under_the_option(spark, sf_small):
    """The test data have one spelling of everything: nothing changes but the order of text."""
    plain, under = (registry.star_queries(p) for p in (FIXTURE, replace(FIXTURE, collation=CI_AI)))
    for name in ("q03_distinct_countries", "q09_customers_by_gender", "q12_revenue_by_category", "q14_items_by_country", "q24_product_year_over_year", "q25_category_share", "q26_cost_ranges", "q27_customers_by_segment", "rp2_report_products"):
        if name in plain:
            rows = [sorted(map(str, (tuple(r) for r in q[name](spark, sf_small).collect()))) for q in (plain, under)]
            assert rows[0] == rows[1], name
    assert testdata.star(spark, sf_small).products.schema["cat"].dataType.simpleString() == "string"
