"""DQ10: every rule counts what it loses, missing and unreadable apart, in the query and during the silver write."""

import datetime as dt

from pyspark.sql import Observation

from starbeam.operators import cleaning, quality

AS_OF = dt.date(2026, 1, 1)


def raw(spark):
    text = lambda rows, *names: spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    return {
        "raw_cust_info": text([("1.0", "a"), ("x", "b"), (None, "c"), (" ", "d"), ("1.0", "a")], "cst_id", "cst_key"),
        "raw_prd_info": text([("1", "CO-RF-FR", "1.5", "2012-01-31", "99/99/2012"), ("2", "CO-RF", "dear", "", None), ("3", "A-B-C", None, "soon", "12/31/2012")], "prd_id", "prd_key", "prd_cost", "prd_start_dt", "prd_end_dt"),
        "raw_sales_details": text([
            ("1", "p", "11", "20120131", "0", "20120132", "10", "2", "5"), ("2", "p", "c", "20120131", None, "", "x", "two", "five"), ("3", "p", None, "2012", "20120101", "20120101", "1", "1" + "0" * 13, "1" + "0" * 13),
        ], "sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt", "sls_due_dt", "sls_sales", "sls_quantity", "sls_price"),
        "raw_cust_az12": text([("1", "2030-01-01"), ("2", "1980-13-01"), ("3", None), ("4", "1980-01-01")], "CID", "BDATE"),
    }


WANT = {
    "CLN5_cst_id_missing": 2, "CLN5_cst_id_null": 1, "CLN6_prd_cost_missing": 1, "CLN6_prd_cost_zero": 1, "CLN8_prd_start_dt_missing": 1, "CLN8_prd_start_dt_null": 1,
    "CLN8_prd_end_dt_missing": 1, "CLN8_prd_end_dt_null": 1, "CLN7_prd_key_short": 1, "CLN9_sls_order_dt_missing": 0, "CLN9_sls_order_dt_null": 1, "CLN9_sls_ship_dt_missing": 1,
    "CLN9_sls_ship_dt_null": 1, "CLN9_sls_due_dt_missing": 1, "CLN9_sls_due_dt_null": 1, "CLN6_sls_quantity_missing": 0, "CLN6_sls_quantity_zero": 1, "CLN6_sls_price_missing": 0,
    "CLN6_sls_price_zero": 1, "CLN6_sls_sales_missing": 0, "CLN6_sls_sales_zero": 1, "CLN5_sls_cust_id_missing": 1, "CLN5_sls_cust_id_null": 1, "CLN10_sales_amount_overflow": 1,
    "CLN8_bdate_missing": 1, "CLN8_bdate_null": 1, "CLN12_bdate_future": 1,
}


def test_every_rule_counts_its_losses(spark):
    found = {r.metric: r.value for r in quality.values_lost_by_rule(raw(spark), AS_OF).collect()}
    assert found == WANT


def test_the_same_counts_are_observed_during_the_write(spark):
    losses = {}
    for name, df in raw(spark).items():
        losses[name] = Observation()
        _, cleaned = cleaning.clean(name, df, AS_OF, losses=losses[name])
        cleaned.write.format("noop").mode("overwrite").save()
    found = quality.observed_losses(spark, {k: dict(o.get) for k, o in losses.items()})
    assert {r.metric: r.value for r in found.collect()} == WANT
    assert {r.check_id for r in found.collect()} == {"DQ10"}
