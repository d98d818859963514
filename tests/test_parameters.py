"""Parameters of the gold layer and rules on every alias: join key by match rate, cost column, two alias columns."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest

from starbeam.config import DEFAULT
from starbeam.operators import cleaning, dimensions


@pytest.fixture(scope="module")
def customers(spark):
    crm = spark.createDataFrame([(1, "AW1", "Ann"), (2, "AW2", "Ben"), (3, "AW9", "Cy"), (None, "AW3", "Di")], "cst_id bigint, cst_key string, cst_firstname string")
    erp = spark.createDataFrame([("NASAW1", "Male"), ("AW2", "Female"), ("3", None), ("NASAW3", None)], "cid string, gen string")
    loc = spark.createDataFrame([("AW1", "France"), ("3", "Germany")], "cid string, cntry string")
    return crm, erp, loc


def test_join_key_is_a_parameter(customers):
    found = lambda p: {r.cst_key: (r.cid, r.cntry) for r in dimensions.dim_customers(*customers, p).collect()}
    assert found(DEFAULT) == {"AW1": (None, None), "AW2": (None, None), "AW9": ("3", "Germany"), "AW3": (None, None)}
    by_key = replace(DEFAULT, customer_join_key="cst_key")
    assert found(by_key) == {"AW1": ("AW1", "France"), "AW2": ("AW2", None), "AW9": (None, None), "AW3": ("AW3", None)}


def test_a_wrong_key_fails_with_all_rates(customers):
    rates = dimensions.join_key_rates(*customers[:2])
    assert {r.join_key: (r.customers, r.matched, r.match_rate) for r in rates.collect()} == {"cst_id": (4, 1, 0.25), "cst_key": (4, 3, 0.75)}
    with pytest.raises(ValueError, match=r"of cst_id below 0.5: cst_id 0.25, cst_key 0.75"):
        dimensions.check_join_key(rates, replace(DEFAULT, min_customer_match_rate=0.5))
    dimensions.check_join_key(rates, replace(DEFAULT, min_customer_match_rate=0.5, customer_join_key="cst_key"))
    dimensions.check_join_key(dimensions.join_key_rates(customers[0].limit(0), customers[1]), replace(DEFAULT, min_customer_match_rate=0.5))


def test_cost_column_of_lines_or_products(spark):
    fact = spark.createDataFrame([("p", Decimal(10), Decimal(2), "1.5"), ("p", Decimal(7), Decimal(1), "x"), ("q", Decimal(5), Decimal(1), None)], "sls_prd_key string, sales_amount decimal(20,4), sls_quantity decimal(14,4), unit_cost string")
    products = spark.createDataFrame([("p", Decimal(4), Decimal(3))], "prd_key string, prd_cost decimal(18,4), list_cost decimal(18,4)")
    profit = lambda p: sorted((r.sls_prd_key, r.profit) for r in dimensions.add_profit(fact, products, p).where("sls_prd_key = 'p'").collect())
    assert profit(DEFAULT) == [("p", Decimal(2)), ("p", Decimal(3))]
    assert profit(replace(DEFAULT, profit_cost="list_cost")) == [("p", Decimal(4)), ("p", Decimal(4))]
    assert profit(replace(DEFAULT, profit_cost="unit_cost")) == [("p", Decimal(7)), ("p", Decimal(7))]
    assert dimensions.add_profit(fact, products, DEFAULT).where("sls_prd_key = 'q'").first().profit is None
    with pytest.raises(KeyError, match="no_such"):
        dimensions.add_profit(fact, products, replace(DEFAULT, profit_cost="no_such"))


def test_every_alias_is_cleaned(spark):
    crm = spark.createDataFrame([("1.0", "2.0", "m", " F ", "s", "MARRIED")], "cst_id string, customer_id string, cst_gndr string, gender string, cst_marital_status string, marital_status string")
    r = cleaning.clean("raw_cust_info", crm, DEFAULT.as_of)[1].first()
    assert tuple(r) == (1, 2, "Male", "Female", "Single", "Married")
    sales = spark.createDataFrame([("o", "p", "1", "20120131", "20120201", "2", "x", "3", "4", "5")], "sls_ord_num string, sls_prd_key string, sls_cust_id string, sls_order_dt string, order_date string, sls_quantity string, quantity string, sls_price string, price string, sls_sales string")
    r = cleaning.clean("raw_sales_details", sales, DEFAULT.as_of)[1].first()
    assert (r.sls_order_dt, r.order_date, r.sls_quantity, r.quantity, r.sls_price, r.price) == (dt.date(2012, 1, 31), dt.date(2012, 2, 1), 2, 0, 3, 4)
    lost = cleaning.loss_measures("raw_sales_details", sales.columns, DEFAULT.as_of)
    assert "CLN6_quantity_zero" in lost and "CLN9_order_date_null" in lost
    erp = spark.createDataFrame([("1", "1980-01-02", "2999-01-01")], "cid string, bdate string, birth_date string")
    assert tuple(cleaning.clean("raw_cust_az12", erp, DEFAULT.as_of)[1].first()) == ("1", dt.date(1980, 1, 2), None)
