"""The catalogue of named analytic queries over the star schema (Q1-Q27).

Every query is a function ``(star, params) -> DataFrame``. Money is summed as
DECIMAL(18,2) (exact, independent of partitioning) and returned as DOUBLE.
Ranking queries take their top rows with ``orderBy().limit()`` on a unique order
(planned as TakeOrderedAndProject: a per-partition top-k, no single-partition
window over all groups) and number only those rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starbeam import config
from starbeam.config import Params
from starbeam.functions import binning, dates
from starbeam.operators.joins import Measure, rollup_over_dimension
from starbeam.plans.star import Star


def _money(c) -> F.Column:
    return c.cast("double")


# ---------------------------------------------------------------- 01 exploration

def q01_gold_tables(star: Star, p: Params, reports: dict | None = None) -> DataFrame:
    """Tables of the gold layer with their type, row and column counts."""
    from starbeam.operators import dimensions, reports as rp

    tables = {
        "dim_customers": star.customers,
        "dim_products": star.products,
        "dim_date": star.dates if star.dates is not None else dimensions.dim_date(star.fact),
        # a left join on a unique order key keeps every line: the lines alone are counted
        "fact_sales": star.fact if reports is not None else star.lines,
    }
    widths = {"fact_sales": len(star.fact.columns)}
    if reports is None:
        # a report has a row per key that it joins: the keys are counted, its measures are not computed
        widths |= {"report_customers": len(rp.report_customers(star, p).columns),
                   "report_products": len(rp.report_products(star, p).columns)}
        reports = {"report_customers": rp.customer_report_keys(star), "report_products": rp.product_report_keys(star)}
    tables.update(reports)
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            F.lit("BASE TABLE").alias("table_type"),
            F.lit(widths.get(name, len(df.columns))).cast("bigint").alias("column_count"),
            "row_count",
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy("table_name")


def q02_customer_columns(star: Star, p: Params) -> DataFrame:
    """Column profile of dim_customers: type, observed nullability, distinct count,
    longest text form. One pass: each row is unpivoted to (column, value) pairs and
    aggregated per column (partial aggregation before the shuffle)."""
    df = star.customers
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    order = {name: i + 1 for i, name in enumerate(df.columns)}
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in df.columns
    ])).alias("kv")).select("kv.column_name", "kv.value")
    prof = stacked.groupBy("column_name").agg(
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.count_distinct("value").alias("distinct_count"),
        F.max(F.length("value")).alias("observed_max_length"),
    )
    meta = df.sparkSession.createDataFrame(
        [(c, types[c], order[c]) for c in df.columns],
        "column_name string, data_type string, ordinal_position int",
    )
    return (prof.join(F.broadcast(meta), "column_name")
            .select(
                "column_name", "data_type", "ordinal_position",
                F.when(F.col("null_count") > 0, F.lit("YES")).otherwise(F.lit("NO")).alias("is_nullable"),
                F.col("null_count").cast("bigint").alias("null_count"),
                F.col("distinct_count").cast("bigint").alias("distinct_count"),
                F.coalesce(F.col("observed_max_length"), F.lit(0)).cast("bigint").alias("max_length"),
            ).orderBy("ordinal_position"))


# ---------------------------------------------------------------- 02 data exploration

def q03_distinct_countries(star: Star, p: Params) -> DataFrame:
    return star.customers.select(F.col("cntry").alias("country")).distinct().orderBy("country")


def q04_product_catalogue(star: Star, p: Params) -> DataFrame:
    return (star.products
            .select(F.col("cat").alias("category"), F.col("subcat").alias("subcategory"),
                    F.col("prd_nm").alias("product_name"))
            .distinct()
            .orderBy("category", "subcategory", "product_name"))


def q05_order_date_range(star: Star, p: Params) -> DataFrame:
    f = star.fact.where(F.col("sls_order_dt").isNotNull())
    agg = f.agg(F.min("sls_order_dt").alias("first_order_date"),
                F.max("sls_order_dt").alias("last_order_date"))
    return agg.select("first_order_date", "last_order_date",
                      dates.full_months("first_order_date", "last_order_date").cast("bigint")
                      .alias("duration_months"))


def q06_customer_age_range(star: Star, p: Params) -> DataFrame:
    c = star.customers.where(F.col("bdate").isNotNull())
    agg = c.agg(F.max("bdate").alias("youngest_birthdate"), F.min("bdate").alias("oldest_birthdate"))
    return agg.select(
        "youngest_birthdate",
        dates.full_years("youngest_birthdate", p.as_of).cast("bigint").alias("youngest_age"),
        "oldest_birthdate",
        dates.full_years("oldest_birthdate", p.as_of).cast("bigint").alias("oldest_age"),
    )


def q07_key_metrics(star: Star, p: Params) -> DataFrame:
    """Six headline measures as (name, value) rows.

    One aggregate pass over the sales lines (instead of one scan per measure), one
    over each dimension; each pass yields one row, unpivoted with ``stack``.
    """
    sales = star.lines.agg(
        F.sum("sales_amount").cast("double").alias("m0"),
        F.sum("sls_quantity").cast("double").alias("m1"),
        F.round(F.avg("sls_price"), 2).cast("double").alias("m2"),
        F.count_distinct("sls_ord_num").cast("double").alias("m3"),
    )
    names = config.KEY_METRICS
    stack = "stack(4, " + ", ".join(f"'{names[i]}', m{i}" for i in range(4)) + ") as (measure_name, measure_value)"
    fact_rows = sales.selectExpr(stack)
    prod = star.products.agg(F.count_distinct("prd_key").cast("double").alias("measure_value")) \
        .select(F.lit(names[4]).alias("measure_name"), "measure_value")
    cust = star.customers.agg(F.count_distinct("cst_id").cast("double").alias("measure_value")) \
        .select(F.lit(names[5]).alias("measure_name"), "measure_value")
    return fact_rows.unionByName(prod).unionByName(cust)


# ---------------------------------------------------------------- 03 magnitude

def q08_customers_by_country(star: Star, p: Params) -> DataFrame:
    return (star.customers.groupBy(F.col("cntry").alias("country"))
            .agg(F.count("cst_id").alias("total_customers"))
            .orderBy(F.desc("total_customers"), F.asc_nulls_first("country")))


def q09_customers_by_gender(star: Star, p: Params) -> DataFrame:
    return (star.customers.groupBy(F.col("cst_gndr").alias("gender"))
            .agg(F.count("cst_id").alias("total_customers"))
            .orderBy(F.desc("total_customers"), F.asc_nulls_first("gender")))


def q10_products_by_category(star: Star, p: Params) -> DataFrame:
    return (star.products.groupBy(F.col("cat").alias("category"))
            .agg(F.count("prd_key").alias("total_products"))
            .orderBy(F.desc("total_products"), F.asc_nulls_first("category")))


def q11_avg_cost_by_category(star: Star, p: Params) -> DataFrame:
    return (star.products.groupBy(F.col("cat").alias("category"))
            .agg(F.round(F.avg("prd_cost"), 2).cast("double").alias("avg_cost"))
            .orderBy(F.desc("avg_cost"), F.asc_nulls_first("category")))


def _by_product(star: Star, p: Params, by, measures, fact=None, fact_by=()) -> DataFrame:
    return rollup_over_dimension(fact if fact is not None else star.lines, "sls_prd_key",
                                 star.products, "prd_key", by, measures, how="left", fact_by=fact_by)


def _by_customer(star: Star, p: Params, by, measures) -> DataFrame:
    return rollup_over_dimension(star.fact, "sls_cust_id", star.customers, "cst_id", by, measures, how="left")


def q12_revenue_by_category(star: Star, p: Params) -> DataFrame:
    agg = _by_product(star, p, ["cat"], [Measure("total_revenue", "sum", "sales_amount")])
    return (agg.select(F.col("cat").alias("category"), _money(F.col("total_revenue")).alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), F.asc_nulls_first("category")))


_CUSTOMER_NAME = ["cst_id", "cst_firstname", "cst_lastname"]


def _customer_cols(*extra) -> list:
    return [F.col("cst_id").alias("customer_id"), F.col("cst_firstname").alias("first_name"),
            F.col("cst_lastname").alias("last_name"), *extra]


def q13_revenue_by_customer(star: Star, p: Params) -> DataFrame:
    agg = _by_customer(star, p, _CUSTOMER_NAME, [Measure("total_revenue", "sum", "sales_amount")])
    top = (agg.select(*_customer_cols("total_revenue"))
           .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_first("customer_id"))
           .limit(p.top_customers_revenue))
    return top.withColumn("total_revenue", _money(F.col("total_revenue")))


def q14_items_by_country(star: Star, p: Params) -> DataFrame:
    agg = _by_customer(star, p, ["cntry"], [Measure("total_sold_items", "sum", "sls_quantity")])
    return (agg.select(F.col("cntry").alias("country"), F.col("total_sold_items").cast("double"))
            .orderBy(F.desc_nulls_last("total_sold_items"), F.asc_nulls_first("country")))


# ---------------------------------------------------------------- 04 ranking

def _revenue_by_product_name(star: Star, p: Params) -> DataFrame:
    agg = _by_product(star, p, ["prd_nm"], [Measure("total_revenue", "sum", "sales_amount")])
    return agg.select(F.col("prd_nm").alias("product_name"), "total_revenue")


def q15_top_products(star: Star, p: Params) -> DataFrame:
    """Top products by revenue with their rank. The rank of a row among the top-k
    equals its rank in the whole set, so the window runs over k rows only."""
    top = (_revenue_by_product_name(star, p)
           .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_first("product_name"))
           .limit(p.top_products))
    w = Window.orderBy(F.desc_nulls_last("total_revenue"))
    return (top.withColumn("product_rank", F.rank().over(w).cast("bigint"))
            .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_first("product_name"))
            .select("product_name", _money(F.col("total_revenue")).alias("total_revenue"), "product_rank"))


def q16_bottom_products(star: Star, p: Params) -> DataFrame:
    return (_revenue_by_product_name(star, p)
            .orderBy(F.asc_nulls_first("total_revenue"), F.asc_nulls_first("product_name"))
            .limit(p.bottom_products)
            .withColumn("total_revenue", _money(F.col("total_revenue"))))


def q17_top_customers(star: Star, p: Params) -> DataFrame:
    agg = _by_customer(star, p, _CUSTOMER_NAME, [Measure("total_revenue", "sum", "sales_amount")])
    order = [F.desc_nulls_last("total_revenue"), F.asc_nulls_first("customer_id")]
    top = agg.select(*_customer_cols("total_revenue")).orderBy(*order).limit(p.top_customers_ranked)
    return (top.withColumn("customer_rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
            .withColumn("total_revenue", _money(F.col("total_revenue")))
            .orderBy("customer_rank"))


def q18_fewest_order_customers(star: Star, p: Params) -> DataFrame:
    agg = _by_customer(star, p, _CUSTOMER_NAME, [Measure("total_orders", "count_distinct", "sls_ord_num")])
    return (agg.select(*_customer_cols(F.col("total_orders").cast("bigint")))
            .orderBy(F.asc("total_orders"), F.asc_nulls_first("customer_id"))
            .limit(p.fewest_order_customers))


# ---------------------------------------------------------------- 05 time series

def _dated(star: Star) -> DataFrame:
    return star.fact.where(F.col("sls_order_dt").isNotNull())


def q19_seasonality_by_month(star: Star, p: Params) -> DataFrame:
    return (_dated(star).groupBy(F.month("sls_order_dt").alias("order_month"))
            .agg(_money(F.sum("sales_amount")).alias("total_sales"),
                 F.count_distinct("sls_cust_id").alias("total_customers"),
                 F.sum("sls_quantity").cast("double").alias("total_quantity"))
            .orderBy(F.desc("total_sales"), "order_month"))


def q20_sales_by_year_month(star: Star, p: Params) -> DataFrame:
    """Grouped by the month's first day; the text form is made for the result rows only."""
    monthly = (_dated(star).groupBy(F.trunc("sls_order_dt", "MM").alias("month"))
               .agg(F.sum("sales_amount").alias("total_sales"),
                    F.count_distinct("sls_cust_id").alias("total_customers"),
                    F.sum("sls_quantity").cast("double").alias("total_quantity")))
    return (monthly.orderBy("month")
            .select(F.date_format("month", "yyyy-MMM").alias("order_month"),
                    _money(F.col("total_sales")).alias("total_sales"), "total_customers", "total_quantity"))


def _yearly(star: Star) -> DataFrame:
    """Sales and mean line price per order year (a handful of rows)."""
    return (_dated(star).groupBy(F.year("sls_order_dt").alias("order_year"))
            .agg(F.sum("sales_amount").alias("total_sales"), F.avg("sls_price").alias("avg_price")))


def q21_running_totals(star: Star, p: Params) -> DataFrame:
    """Running sum of yearly sales and running mean of the yearly mean prices.
    The window (default RANGE frame) runs over the aggregated years only."""
    w = Window.orderBy("order_year")
    return (_yearly(star).select(
        "order_year",
        _money(F.col("total_sales")).alias("total_sales"),
        _money(F.sum("total_sales").over(w)).alias("running_total_sales"),
        F.round("avg_price", 2).cast("double").alias("avg_price"),
        F.round(F.avg("avg_price").over(w), 2).cast("double").alias("running_avg_price"),
    ).orderBy("order_year"))


def q22_rolling_totals(star: Star, p: Params) -> DataFrame:
    """Two-row rolling sum and mean (rows, not calendar years)."""
    w = Window.orderBy("order_year").rowsBetween(-1, 0)
    return (_yearly(star).select(
        "order_year",
        _money(F.col("total_sales")).alias("total_sales"),
        _money(F.sum("total_sales").over(w)).alias("rolling_total_sales"),
        F.round("avg_price", 2).cast("double").alias("avg_price"),
        F.round(F.avg("avg_price").over(w), 2).cast("double").alias("rolling_avg_price"),
    ).orderBy("order_year"))


# ---------------------------------------------------------------- 07 performance

def q23_yearly_vs_average(star: Star, p: Params) -> DataFrame:
    yearly = (_dated(star).groupBy(F.year("sls_order_dt").alias("date_year"))
              .agg(F.avg("sales_amount").alias("avg_sales_yearly")))
    ranked = yearly.select(
        "date_year", "avg_sales_yearly",
        F.avg("avg_sales_yearly").over(Window.partitionBy()).alias("avg_sales_overall"),
        F.lag("avg_sales_yearly").over(Window.orderBy("date_year")).alias("previous_year_sales"),
    )
    return ranked.select(
        "date_year",
        F.col("avg_sales_yearly").cast("double").alias("avg_sales_yearly"),
        F.round("avg_sales_overall", 2).cast("double").alias("avg_sales_overall"),
        F.col("previous_year_sales").cast("double").alias("previous_year_sales"),
        binning.three_way(F.col("avg_sales_yearly"), F.col("avg_sales_overall"), config.YEAR_COMPARE)
        .alias("compare_to_avg"),
        binning.three_way(F.col("avg_sales_yearly"), F.col("previous_year_sales"), config.LAST_YEAR_COMPARE)
        .alias("compare_to_last_year"),
    ).orderBy("date_year")


def q24_product_yearly_performance(star: Star, p: Params) -> DataFrame:
    """Product (by name) per order year vs its own mean and its prior year. The
    windows partition by product name over (year, name) aggregates, at most one
    row per year in each partition."""
    base = _by_product(star, p, ["prd_nm"], [Measure("current_sales", "sum", "sales_amount")],
                       fact=_dated(star), fact_by=[("order_year", F.year("sls_order_dt"))])
    base = base.withColumnRenamed("prd_nm", "product_name")
    by_name = Window.partitionBy("product_name")
    ranked = base.select(
        "order_year", "product_name", "current_sales",
        F.avg("current_sales").over(by_name).alias("avg_sales"),
        F.lag("current_sales").over(by_name.orderBy("order_year")).alias("prev_year_sales"),
    )
    cur, avg, prev = F.col("current_sales"), F.col("avg_sales"), F.col("prev_year_sales")
    return ranked.select(
        "order_year", "product_name",
        cur.cast("double").alias("current_sales"),
        F.round(avg, 2).cast("double").alias("avg_sales"),
        (cur - avg).cast("double").alias("diff_avg"),
        binning.three_way(cur, avg, config.PRODUCT_AVG_COMPARE).alias("avg_change"),
        prev.cast("double").alias("prev_year_sales"),
        (cur - prev).cast("double").alias("diff_prev_year"),
        binning.three_way(cur, prev, config.PRODUCT_PREV_COMPARE, null_label=None).alias("prev_year_change"),
    ).orderBy(F.asc_nulls_first("product_name"), "order_year")


# ---------------------------------------------------------------- 08 part-to-whole

def q25_category_share(star: Star, p: Params) -> DataFrame:
    """Category share of all sales. The overall total is a window over the
    aggregated categories (one row per category)."""
    agg = _by_product(star, p, ["cat"], [Measure("total_sales", "sum", "sales_amount")])
    shares = agg.select(
        F.col("cat").alias("category"), "total_sales",
        F.sum("total_sales").over(Window.partitionBy()).alias("overall_sales"),
    )
    pct = F.round(F.col("total_sales") * 100 / F.col("overall_sales"), 2)
    return shares.select(
        "category",
        _money(F.col("total_sales")).alias("total_sales"),
        _money(F.col("overall_sales")).alias("overall_sales"),
        pct.cast("double").alias("pct_of_total"),
        F.concat(pct.cast("string"), F.lit("%")).alias("percentage_of_total"),
    ).orderBy(F.desc("total_sales"), F.asc_nulls_first("category"))


# ---------------------------------------------------------------- 09 segmentation

def q26_products_by_cost_range(star: Star, p: Params) -> DataFrame:
    return (star.products
            .select("prd_key", binning.cost_range("prd_cost", p.cost_bounds).alias("cost_range"))
            .groupBy("cost_range").agg(F.count("prd_key").alias("total_products"))
            .orderBy(F.desc("total_products"), "cost_range"))


def q27_customers_by_segment(star: Star, p: Params, report: DataFrame | None = None) -> DataFrame:
    from starbeam.operators.reports import customer_segments

    rc = report if report is not None else customer_segments(star, p)
    return (rc.groupBy("customer_segment").agg(F.count("cst_id").alias("total_customers"))
            .orderBy(F.desc("total_customers"), "customer_segment"))


QUERIES = {
    "q01_gold_tables": q01_gold_tables,
    "q02_customer_columns": q02_customer_columns,
    "q03_distinct_countries": q03_distinct_countries,
    "q04_product_catalogue": q04_product_catalogue,
    "q05_order_date_range": q05_order_date_range,
    "q06_customer_age_range": q06_customer_age_range,
    "q07_key_metrics": q07_key_metrics,
    "q08_customers_by_country": q08_customers_by_country,
    "q09_customers_by_gender": q09_customers_by_gender,
    "q10_products_by_category": q10_products_by_category,
    "q11_avg_cost_by_category": q11_avg_cost_by_category,
    "q12_revenue_by_category": q12_revenue_by_category,
    "q13_revenue_by_customer": q13_revenue_by_customer,
    "q14_items_by_country": q14_items_by_country,
    "q15_top_products": q15_top_products,
    "q16_bottom_products": q16_bottom_products,
    "q17_top_customers": q17_top_customers,
    "q18_fewest_order_customers": q18_fewest_order_customers,
    "q19_seasonality_by_month": q19_seasonality_by_month,
    "q20_sales_by_year_month": q20_sales_by_year_month,
    "q21_running_totals": q21_running_totals,
    "q22_rolling_totals": q22_rolling_totals,
    "q23_yearly_vs_average": q23_yearly_vs_average,
    "q24_product_yearly_performance": q24_product_yearly_performance,
    "q25_category_share": q25_category_share,
    "q26_products_by_cost_range": q26_products_by_cost_range,
    "q27_customers_by_segment": q27_customers_by_segment,
}
