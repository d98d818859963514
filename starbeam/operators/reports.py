"""Customer and product reports (RP1, RP2).

Both reports aggregate the dated fact to the dimension key first, then join the
dimension: the join sees one row per customer / product instead of one per sale,
and every dimension attribute is carried by the join instead of being re-grouped.
Sums and the distinct orders come from one two-step aggregate (per key and order,
then per key); the other distinct count is a branch of its own, so no sale is
multiplied before the shuffle as two distinct counts in one aggregate would do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbeam.config import Params
from starbeam.functions import binning, dates
from starbeam.functions.numeric import half_even, ratio_or
from starbeam.plans.star import Star


def _dated_fact(star: Star) -> DataFrame:
    return star.fact.where(F.col("sls_order_dt").isNotNull())


def _per_key(star: Star, key: str, other: str, other_name: str, last: str, first: str) -> DataFrame:
    """Totals per ``key``; ``other_name`` counts the distinct ``other`` of the key."""
    sales = _dated_fact(star).where(F.col(key).isNotNull())
    per_order = sales.groupBy(key, "sls_ord_num").agg(
        F.sum("sales_amount").alias("s"), F.sum("sls_quantity").alias("q"),
        F.max("sls_order_dt").alias("hi"), F.min("sls_order_dt").alias("lo"))
    money = star.fact.schema["sales_amount"].dataType  # summed twice, typed as one sum: divisions keep their places
    total = F.sum("s").cast(f"decimal({min(38, money.precision + 10)},{money.scale})")
    totals = per_order.groupBy(key).agg(
        F.count("sls_ord_num").alias("total_orders"), total.alias("total_sales"),
        F.sum("q").alias("total_quantity"), F.max("hi").alias(last), F.min("lo").alias(first))
    others = (sales.where(F.col(other).isNotNull()).select(key, other).distinct()
              .groupBy(key).agg(F.count(F.lit(1)).alias(other_name)))
    return totals.join(others, key, "left").withColumn(other_name, F.coalesce(other_name, F.lit(0)))


def _named_customers(star: Star) -> DataFrame:
    return star.customers.where(F.col("cst_firstname").isNotNull() & F.col("cst_lastname").isNotNull())


def customer_report_keys(star: Star) -> DataFrame:
    """The customers of the customer report, without its measures: enough to count its rows."""
    sold = _dated_fact(star).select(F.col("sls_cust_id").alias("cst_id")).where("cst_id is not null").distinct()
    return sold.join(_named_customers(star).select("cst_id"), "cst_id")


def product_report_keys(star: Star) -> DataFrame:
    """The products of the product report, without its measures."""
    sold = _dated_fact(star).select(F.col("sls_prd_key").alias("prd_key")).where("prd_key is not null").distinct()
    return sold.join(star.products.select("prd_key"), "prd_key")


def _sold(star: Star, key: str) -> DataFrame:
    """Sales, first and last date per ``key``, in one step: what a segment needs."""
    return _dated_fact(star).where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum("sales_amount").alias("total_sales"), F.max("sls_order_dt").alias("last"), F.min("sls_order_dt").alias("first"))


def customer_segments(star: Star, p: Params) -> DataFrame:
    """(cst_id, customer_segment) of the customer report."""
    sold = _sold(star, "sls_cust_id")
    joined = sold.join(_named_customers(star).select("cst_id"), sold["sls_cust_id"] == F.col("cst_id"))
    lifespan = dates.calendar_months_clipped("last", "first").cast("bigint").alias("lifespan")
    return joined.select("cst_id", "total_sales", lifespan).select(
        "cst_id", binning.customer_segment("lifespan", F.col("total_sales"), p).alias("customer_segment"))


def product_segments(star: Star, p: Params) -> DataFrame:
    """(prd_key, product_segment) of the product report."""
    sold = _sold(star, "sls_prd_key")
    joined = sold.join(star.products.select("prd_key"), sold["sls_prd_key"] == F.col("prd_key"))
    return joined.select("prd_key", binning.product_segment(F.col("total_sales"), p).alias("product_segment"))


def report_customers(star: Star, p: Params) -> DataFrame:
    """One row per customer with sales: totals, recency, age band, segment, KPIs.

    Customers whose first or last name is missing are left out (grouping on the
    name drops them in the source system).
    """
    per_customer = _per_key(star, "sls_cust_id", "sls_prd_key", "total_products",
                            "last_order_date", "first_order_date")
    customers = _named_customers(star).select("cst_id", "cst_firstname", "cst_lastname", "bdate", "cst_gndr", "cntry")
    joined = per_customer.join(customers, per_customer["sls_cust_id"] == customers["cst_id"], "inner")

    lifespan = dates.calendar_months_clipped("last_order_date", "first_order_date")
    age = dates.age_years("bdate", p.as_of)
    staged = joined.select(
        "cst_id", "cst_firstname", "cst_lastname",
        F.col("total_orders").cast("bigint").alias("total_orders"),
        "total_sales",
        "total_quantity",
        F.col("total_products").cast("bigint").alias("total_products"),
        "last_order_date",
        age.alias("age"),
        "cst_gndr", "cntry",
        lifespan.cast("bigint").alias("lifespan"),
        dates.calendar_months(F.lit(p.as_of), "last_order_date").cast("bigint").alias("recency_months"),
    )
    sales = F.col("total_sales")
    return staged.select(
        "cst_id", "cst_firstname", "cst_lastname", "total_orders",
        sales.cast("double").alias("total_sales"),
        F.col("total_quantity").cast("double").alias("total_quantity"), "total_products", "last_order_date", "age", "cst_gndr", "cntry",
        "lifespan", "recency_months",
        binning.age_group("age").alias("age_group"),
        binning.customer_segment("lifespan", sales, p).alias("customer_segment"),
        half_even(ratio_or(sales, "total_orders", F.lit(0)), 2).cast("double").alias("avg_order_value"),
        half_even(ratio_or(sales, "lifespan", sales), 2).cast("double").alias("avg_monthly_spend"),
    )


def report_products(star: Star, p: Params) -> DataFrame:
    """One row per product with sales: totals, recency, segment, KPIs.

    Grouped by product key with the product attributes carried along, so a
    product without a category is kept. The layered run fails when the written
    report has no rows (a key mismatch between the two sources).
    """
    per_product = _per_key(star, "sls_prd_key", "sls_cust_id", "total_customers",
                           "last_sale_date", "first_sale_date")
    products = star.products.select("prd_key", "prd_nm", "cat", "subcat", "prd_cost")
    joined = per_product.join(products, per_product["sls_prd_key"] == products["prd_key"], "inner")

    lifespan = dates.calendar_months_clipped("last_sale_date", "first_sale_date")
    staged = joined.select(
        "prd_key", "prd_nm", "cat", "subcat", "prd_cost",
        F.col("total_orders").cast("bigint").alias("total_orders"),
        F.col("total_customers").cast("bigint").alias("total_customers"),
        "total_sales",
        "total_quantity",
        "last_sale_date",
        lifespan.cast("bigint").alias("lifespan"),
        dates.calendar_months(F.lit(p.as_of), "last_sale_date").cast("bigint").alias("recency_months"),
    )
    sales = F.col("total_sales")
    return staged.select(
        "prd_key", "prd_nm", "cat", "subcat",
        F.col("prd_cost").cast("double").alias("prd_cost"),
        "total_orders", "total_customers",
        sales.cast("double").alias("total_sales"),
        F.col("total_quantity").cast("double").alias("total_quantity"), "last_sale_date", "lifespan", "recency_months",
        binning.product_segment(sales, p).alias("product_segment"),
        half_even(ratio_or(sales, "total_quantity", F.lit(0)), 1).cast("double").alias("avg_selling_price"),
        half_even(ratio_or(sales, "total_orders", F.lit(0)), 2).cast("double").alias("avg_order_revenue"),
        half_even(ratio_or(sales, "lifespan", sales), 2).cast("double").alias("avg_monthly_revenue"),
    )
