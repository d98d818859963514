"""Filters after the de-duplication stay after it, so every reader of a cleaned table shares its exchange."""

import pytest

from starbeam.config import FIXTURE
from starbeam.plans import registry


@pytest.mark.parametrize("name", ["dq7_segment_distribution", "dim14_profit"])
def test_the_sales_lines_are_deduplicated_once(spark, sf_small, name):
    found = registry.all_queries(FIXTURE)[name](spark, sf_small)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [line for line in plan.splitlines() if "Exchange hashpartitioning(sls_prd_key" in line and "sls_due_dt" in line]
    assert len([line for line in lines if "ReusedExchange" not in line]) == 1


def test_dates_are_parsed_after_the_exchange(spark, sf_small):
    found = registry.all_queries(FIXTURE)["ag04_distinct_rollup"](spark, sf_small)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    before = plan[plan.index("Aggregate [sls_ord_num" if "Aggregate [sls_ord_num" in plan else "Aggregate [sls_prd_key"):]
    assert "RLIKE(" in plan and "RLIKE(" not in before and "atleastnnonnulls" not in before


def test_profit_parses_only_the_columns_that_it_needs(spark, sf_small):
    found = registry.all_queries(FIXTURE)["dim14_profit"](spark, sf_small)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE(trim(sls_cust_id" in plan and not any(f"RLIKE(trim({c}" in plan for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt"))
