"""Data-quality checks (DQ1-DQ9) as rows of one ``dq_results`` DataFrame.

Every check is an aggregate over a whole table (counts, ``count_if``, anti joins);
nothing is collected to the driver. Rows: (check_id, check_name, table_name,
metric, value).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbeam.functions import dates
from starbeam.operators import cleaning, dimensions
from starbeam.sources.csv_source import BAD_ROW
from starbeam.sources.schemas import resolve

DQ_COLUMNS = ("check_id", "check_name", "table_name", "metric", "value")


def _rows(df: DataFrame, check_id: str, check_name: str, table_name: str, metrics: dict) -> DataFrame:
    """Unpivot one aggregate row into one result row per metric."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(check_id).alias("check_id"), F.lit(check_name).alias("check_name"),
                 F.lit(table_name).alias("table_name"), F.lit(m).alias("metric"),
                 expr.cast("bigint").alias("value"))
        for m, expr in metrics.items()
    ])).alias("r")).select("r.*")


def duplicates_removed(raw: DataFrame, table_name: str) -> DataFrame:
    """DQ1: rows before and after exact de-duplication, and the difference."""
    base = cleaning.normalise_headers(raw).drop(BAD_ROW)
    # one pass: group equal rows (nulls equal, as in de-duplication), then count
    # the groups and their sizes
    groups = base.groupBy(*base.columns).agg(F.count(F.lit(1)).alias("_n"))
    both = groups.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("m"))
    return _rows(both, "DQ1", "duplicates_removed", table_name,
                 {"rows_in": F.col("n"), "rows_out": F.col("m"), "rows_removed": F.col("n") - F.col("m")})


def duplicates_removed_from_counts(spark, table_name: str, rows_in: int, rows_out: int) -> DataFrame:
    """DQ1 from stored row counts: for a table whose cleaner removes no rows besides
    exact duplicates, the written silver table has exactly the de-duplicated rows.
    Both counts come from parquet footers, so no second de-duplication runs."""
    one = spark.createDataFrame([(rows_in, rows_out)], "n bigint, m bigint")
    return _rows(one, "DQ1", "duplicates_removed", table_name,
                 {"rows_in": F.col("n"), "rows_out": F.col("m"), "rows_removed": F.col("n") - F.col("m")})


def null_key_rows_from_counts(spark, rows_in: int, rows_dropped: int) -> DataFrame:
    """DQ2 from counts observed while the silver sales table was written."""
    one = spark.createDataFrame([(rows_in, rows_dropped)], "n bigint, dropped bigint")
    return _rows(one, "DQ2", "null_key_rows_dropped", "clean_sales_details",
                 {"rows_in": F.col("n"), "rows_dropped": F.col("dropped")})


def null_key_rows(raw_sales: DataFrame) -> DataFrame:
    """DQ2: de-duplicated, coerced sales rows that miss an order, product or customer key."""
    staged = cleaning.coerce_integer_key(cleaning.base_clean(raw_sales), "sales_customer")
    keys = cleaning.sales_key_columns(staged)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    agg = staged.agg(F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("dropped"))
    return _rows(agg, "DQ2", "null_key_rows_dropped", "clean_sales_details",
                 {"rows_in": F.col("n"), "rows_dropped": F.col("dropped")})


def future_dates(raw_demographics: DataFrame, as_of: dt.date) -> DataFrame:
    """DQ3: birth dates after ``as_of`` (set to null by cleaning)."""
    staged = cleaning.base_clean(raw_demographics)
    c = resolve(staged.columns, "erp_birthdate", required=True)
    parsed = dates.parse_date(c)
    agg = staged.agg(F.count_if(parsed > F.lit(as_of)).alias("future"), F.count_if(parsed.isNull()).alias("bad"))
    return _rows(agg, "DQ3", "future_birthdates_nulled", "clean_cust_az12",
                 {"future_dates": F.col("future"), "unparseable_or_missing": F.col("bad")})


def malformed_rows(spark, table_name: str, rows: int) -> DataFrame:
    """DQ8: rows of a raw file without the header's fields (kept in bronze with their text)."""
    return _rows(spark.createDataFrame([(rows,)], "n bigint"), "DQ8", "malformed_rows", table_name, {"rows": F.col("n")})


def values_lost(sales: DataFrame, products: DataFrame) -> DataFrame:
    """DQ9: cleaned values that are null, missing inputs included: line amounts
    beyond the type, sales without a readable order date, products without a readable start
    date, and product keys of fewer than three segments (empty after the split)."""
    lines = sales.agg(F.count_if(F.col("sales_amount").isNull()).alias("amount_overflow"),
                      F.count_if(F.col("sls_order_dt").isNull()).alias("no_order_date"))
    keys = products.agg(F.count_if(F.col("prd_start_dt").isNull()).alias("no_start_date"),
                        F.count_if(F.col("prd_key") == "").alias("short_product_key"))
    return _rows(lines, "DQ9", "values_lost", "clean_sales_details",
                 {m: F.col(m) for m in ("amount_overflow", "no_order_date")}).unionByName(
        _rows(keys, "DQ9", "values_lost", "clean_prd_info", {m: F.col(m) for m in ("no_start_date", "short_product_key")}))


def values_lost_by_rule(raw: dict[str, DataFrame], as_of: dt.date, overrides: dict | None = None) -> DataFrame:
    """DQ10: per cleaning rule and column, the values that were missing and those that were present but are
    null, zero, short, too large or in the future (one pass over each raw table)."""
    parts = []
    for name in cleaning.READS:
        staged = cleaning.base_clean(cleaning.canonical(name, raw[name], overrides))
        measures = cleaning.loss_measures(name, staged.columns, as_of)
        agg = staged.agg(*[c.alias(m) for m, c in measures.items()])
        parts.append(_rows(agg, "DQ10", "values_lost_by_rule", cleaning.CLEANERS[name][0], {m: F.col(m) for m in measures}))
    return union_all(parts)


def observed_losses(spark, observed: dict[str, dict]) -> DataFrame:
    """DQ10 from the counts that were observed while the silver tables were written."""
    rows = [("DQ10", "values_lost_by_rule", cleaning.CLEANERS[name][0], m, int(n)) for name, found in observed.items() for m, n in found.items()]
    return spark.createDataFrame(rows, "check_id string, check_name string, table_name string, metric string, value bigint")


def date_orders(spark, votes: dict[str, list[dict]]) -> DataFrame:
    """DQ11: per raw table and free-form date column, the values that only one form can read, those that either can, and
    whether the column's form is a guess (``date_order``)."""
    rows = [("DQ11", "date_order", cleaning.CLEANERS[name][0], f"{v['column_name']}_{m}", int(v[m]))
            for name, found in votes.items() for v in found for m in ("day_first", "month_first", "either", "ambiguous")]
    return spark.createDataFrame(rows, "check_id string, check_name string, table_name string, metric string, value bigint")


def orphans(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """DQ4: fact rows without a customer / product (DIM16)."""
    oc = dimensions.orphan_counts(fact, customers, products)
    return _rows(oc, "DQ4", "orphan_fact_rows", "fact_sales",
                 {"fact_rows": F.col("fact_rows"), "orphan_customer_rows": F.col("orphan_customer_rows"),
                  "orphan_product_rows": F.col("orphan_product_rows")})


def match_rate(dim_customers: DataFrame) -> DataFrame:
    """DQ5: customers after the ERP merge and how many matched (DIM5)."""
    m = dimensions.customer_match_rate(dim_customers)
    return _rows(m, "DQ5", "customer_erp_match", "dim_customers",
                 {"rows_after_merge": F.col("rows_after_merge"), "rows_matched": F.col("rows_matched")})


def nonempty_join(fact: DataFrame, products: DataFrame, fact_key: str = "sls_prd_key",
                  product_key: str = "prd_key") -> DataFrame:
    """DQ6: dated sales that find their product; zero means the keys do not match."""
    dated = fact.where(F.col("sls_order_dt").isNotNull())
    agg = dimensions.rows_by_key(dated, fact_key, products, product_key).select(F.col("matched").alias("n"))
    return _rows(agg, "DQ6", "sales_product_join_nonempty", "report_products",
                 {"matched_rows": F.col("n"), "passed": (F.col("n") > 0).cast("int")})


def segment_distribution(report: DataFrame, segment_col: str, key_col: str, table_name: str) -> DataFrame:
    """DQ7: rows per segment of a report."""
    counts = report.groupBy(segment_col).agg(F.count(key_col).alias("n"))
    return counts.select(
        F.lit("DQ7").alias("check_id"), F.lit("segment_distribution").alias("check_name"),
        F.lit(table_name).alias("table_name"), F.col(segment_col).alias("metric"),
        F.col("n").cast("bigint").alias("value"))


def union_all(parts) -> DataFrame:
    parts = list(parts)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
