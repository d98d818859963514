"""The star schema the analytic queries and reports run on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# Fact columns that come from the sales line alone (no order-header attribute).
LINE_COLUMNS = ("sls_ord_num", "sls_prd_key", "sls_ship_dt", "sls_quantity", "sls_price", "sales_amount")


@dataclass
class Star:
    """fact_sales with its customer, product and (optional) date dimensions.

    ``lines`` is the fact without the order-header columns (customer, order date).
    When the fact is assembled from a line source and an order-header source whose
    key is unique, ``lines`` skips that join; queries that need no header column use
    it. When the fact is a stored table it is a plain projection of it.
    """

    fact: DataFrame
    customers: DataFrame
    products: DataFrame
    dates: DataFrame | None = None
    lines: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.lines is None:
            self.lines = self.fact.select(*LINE_COLUMNS)
