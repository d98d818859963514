"""Dimensional model: customer, product and date dimensions, the sales fact and
its integrity checks (silver -> gold)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbeam import config
from starbeam.config import Params
from starbeam.functions import text
from starbeam.functions.numeric import AMOUNT, PRICE
from starbeam.operators.joins import salted_left_join
from starbeam.operators.keys import keep_first, surrogate_key


def _rest_ascending(df: DataFrame, skip: set[str]) -> list:
    return [F.asc_nulls_first(c) for c in df.columns if c not in skip]


# ---------------------------------------------------------------- customers

def keep_latest_customer(crm: DataFrame) -> DataFrame:
    """DIM1: one row per ``cst_id``, the one with the greatest ``cst_key``
    (remaining columns break ties)."""
    order = [F.desc_nulls_last("cst_key")] + _rest_ascending(crm, {"cst_key", "cst_id"})
    return keep_first(crm, ["cst_id"], order)


def normalise_erp_key(df: DataFrame, key: str, token: str = "NAS") -> DataFrame:
    """DIM3: key as text, ``token`` removed, stripped."""
    return df.withColumn(key, text.remove_prefix_token(key, token))


def keep_first_by_key(df: DataFrame, key: str) -> DataFrame:
    """DIM2: one row per key, the first in the order of all columns (deterministic)."""
    return keep_first(df, [key], _rest_ascending(df, {key}))


def _enrich(left: DataFrame, right: DataFrame, left_key, right_key: str) -> DataFrame:
    """Left join; on a column-name clash the left column wins (JN5)."""
    keep = [c for c in right.columns if c not in set(left.columns) or c == right_key]
    right = right.select(*keep)
    if right_key in left.columns:
        right = right.withColumnRenamed(right_key, f"_{right_key}_r")
        right_key = f"_{right_key}_r"
    return left.join(right, left_key == right[right_key], "left")


def dim_customers(crm: DataFrame, demographics: DataFrame, locations: DataFrame, p: Params) -> DataFrame:
    """DIM4: CRM customers (latest per id) left join ERP demographics left join ERP
    locations, on the text form of ``p.customer_join_key`` against the ERP ids without
    their prefix. ERP columns whose names clash with CRM columns are dropped."""
    crm = keep_latest_customer(crm).withColumn("_merge_key", _merge_key(p.customer_join_key))
    demo = keep_first_by_key(normalise_erp_key(demographics, "cid"), "cid")
    loc = keep_first_by_key(normalise_erp_key(locations, "cid"), "cid").withColumnRenamed("cid", "loc_cid")
    out = _enrich(crm, demo, F.col("_merge_key"), "cid")
    out = _enrich(out, loc, F.col("_merge_key"), "loc_cid")
    drop = [c for c in out.columns if c.startswith("_")]
    return out.drop(*drop)


def _merge_key(column: str) -> Column:
    return text.remove_prefix_token(F.col(column).cast("string"), "NAS")


def join_key_rates(crm: DataFrame, demographics: DataFrame, candidates: tuple[str, ...] = config.CUSTOMER_KEYS) -> DataFrame:
    """(join_key, customers, matched, match_rate): how many of the customers each candidate key would find in the
    ERP, before any table is joined. One pass over the customers; keys meet the distinct ERP ids, so no hot key."""
    present = [c for c in candidates if c in crm.columns]
    keys = F.array(*[F.struct(F.lit(c).alias("join_key"), _merge_key(c).alias("_k")) for c in present])
    pairs = keep_latest_customer(crm).select(F.explode(keys).alias("k")).select("k.*")
    counted = pairs.groupBy("join_key", "_k").agg(F.count(F.lit(1)).alias("_n"))
    known = normalise_erp_key(demographics, "cid").select(F.col("cid").alias("_cid")).where(F.col("_cid").isNotNull()).distinct()
    joined = counted.join(known, counted["_k"] == known["_cid"], "left").groupBy("join_key").agg(
        F.sum("_n").alias("customers"), F.coalesce(F.sum(F.when(F.col("_cid").isNotNull(), F.col("_n"))), F.lit(0)).alias("matched"))
    return joined.withColumn("match_rate", F.round(F.try_divide(F.col("matched"), F.col("customers")), 4))


def check_join_key(rates: DataFrame, p: Params) -> None:
    """Raise if the join key finds fewer customers than ``p.min_customer_match_rate``, naming every candidate's rate."""
    found = {r["join_key"]: r["match_rate"] for r in rates.collect()}  # a row per candidate
    own = found.get(p.customer_join_key)
    if own is not None and own < p.min_customer_match_rate:
        named = ", ".join(f"{k} {v}" for k, v in sorted(found.items()))
        raise ValueError(f"customer match rate of {p.customer_join_key} below {p.min_customer_match_rate}: {named}")


def customer_match_rate(dim: DataFrame) -> DataFrame:
    """DIM5: customers after the merge and how many found their ERP record."""
    return dim.agg(
        F.count(F.lit(1)).alias("rows_after_merge"),
        F.count_if(F.col("cid").isNotNull()).alias("rows_matched"),
    ).select("rows_after_merge", "rows_matched",
             F.round(F.try_divide(F.col("rows_matched"), F.col("rows_after_merge")), 4).alias("match_rate"))


# ---------------------------------------------------------------- products

def active_products(prd: DataFrame) -> DataFrame:
    """DIM6: versions without an end date."""
    return prd.where(F.col("prd_end_dt").isNull())


def latest_product_versions(prd: DataFrame) -> DataFrame:
    """DIM7: the latest version (by start date) of every product key."""
    order = [F.desc_nulls_last("prd_start_dt")] + _rest_ascending(prd, {"prd_key", "prd_start_dt"})
    return keep_first(prd, ["prd_key"], order)


def attach_categories(prd: DataFrame, categories: DataFrame) -> DataFrame:
    """DIM8: left join the category table on the stripped category id."""
    cats = categories.select(text.strip("id").alias("_cat_id"), "cat", "subcat", "maintenance")
    keep = [c for c in cats.columns if c == "_cat_id" or c not in set(prd.columns)]
    # one row per category id keeps the join 1:1 (the source de-duplicates after it)
    cats = keep_first_by_key(cats.select(*keep), "_cat_id")
    return prd.join(cats, text.strip("cat_id") == cats["_cat_id"], "left").drop("_cat_id")


def decode_product_line(c) -> F.Column:
    """DIM10: R, M, S, T to names; missing or unknown -> ``n/a``."""
    return text.lookup(text.upper_strip(c), config.PRODUCT_LINES, F.lit(config.PRODUCT_LINE_MISSING))


def product_rows(prd_clean: DataFrame, categories: DataFrame, p: Params) -> DataFrame:
    """Product dimension rows in the published layout, without the surrogate key:
    latest version per product number, category attached, line decoded."""
    latest = latest_product_versions(prd_clean)
    with_cat = attach_categories(latest, categories)
    return with_cat.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("subcategory"),
        F.col("maintenance"),
        F.col("prd_cost").alias("cost"),
        decode_product_line("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
    )


def dim_products(prd_clean: DataFrame, categories: DataFrame, p: Params) -> DataFrame:
    """DIM9: the product dimension with its surrogate key 1..n by (start date,
    product number), product id last as a tie-break."""
    return surrogate_key(product_rows(prd_clean, categories, p),
                         [F.asc_nulls_first("start_date"), F.asc_nulls_first("product_number"),
                          F.asc_nulls_first("product_id")], "product_key")


# ---------------------------------------------------------------- dates and fact

def dim_date(fact: DataFrame, date_col: str = "sls_order_dt") -> DataFrame:
    """DIM11: every distinct order day (no gap filling) with calendar attributes.
    ISO week beside calendar year (1 Jan may be week 52)."""
    days = fact.select(F.col(date_col).cast("date").alias("date")).where(F.col("date").isNotNull()).distinct()
    weekday = F.date_format("date", "EEEE")
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.weekofyear("date").alias("week"),
        F.dayofmonth("date").alias("day"),
        weekday.alias("weekday"),
        weekday.isin(*config.WEEKEND_DAYS).alias("is_weekend"),
    ).orderBy("date")


def date_range(dates: DataFrame) -> DataFrame:
    """DIM17: first and last day of the date dimension."""
    return dates.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def add_profit(fact: DataFrame, products: DataFrame, p: Params,
               key: str = "sls_prd_key", product_key: str = "prd_key") -> DataFrame:
    """DIM14: profit = sales amount - unit cost x quantity. The unit cost is ``p.profit_cost``: a column of
    the sales lines if they have it (no join then), else of the product dimension (left join: a sale without
    a product has null profit). Every line stays, so hot products are salted instead of aggregated."""
    def profit(cost: Column) -> Column:
        return (F.col("sales_amount") - cost * F.col("sls_quantity")).try_cast(AMOUNT)

    if p.profit_cost in fact.columns:
        return fact.withColumn("profit", profit(F.coalesce(F.col(p.profit_cost).try_cast(PRICE), F.lit(0).cast(PRICE))))
    if p.profit_cost not in products.columns:
        raise KeyError(f"no cost column {p.profit_cost!r} among the sales or products: {fact.columns}, {products.columns}")
    costs = products.select(F.col(product_key).alias("_pk"), F.col(p.profit_cost).alias("_unit_cost"))
    # a hash of every column would have every column parsed, also those that the caller does not read
    deal_by = [c for c in ("sls_ord_num", "sls_quantity", "sales_amount") if c in fact.columns]
    joined = salted_left_join(fact, costs, key, "_pk", deal_by=deal_by)
    return joined.withColumn("profit", profit(F.col("_unit_cost"))).drop("_pk", "_unit_cost")


def fact_totals(fact: DataFrame) -> DataFrame:
    """DIM15: total revenue and row count."""
    return fact.agg(F.sum("sales_amount").cast("double").alias("total_revenue"),
                    F.count(F.lit(1)).alias("total_rows"))


def rows_by_key(fact: DataFrame, key: str, keys: DataFrame, dim_key: str) -> DataFrame:
    """(rows, matched): fact rows and those whose ``key`` is in the dimension. The fact is
    counted per key before the join, so a hot key is one row."""
    counted = fact.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    known = keys.select(F.col(dim_key).alias("_d")).where(F.col("_d").isNotNull()).distinct()
    joined = counted.join(known, counted["_k"] == known["_d"], "left")
    return joined.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
                      F.coalesce(F.sum(F.when(F.col("_d").isNotNull(), F.col("_n"))), F.lit(0)).alias("matched"))


def orphan_counts(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """DIM16: fact rows without a customer / product (a null key is an orphan).
    Non-blocking: returns counts."""
    by_customer = rows_by_key(fact, "sls_cust_id", customers, "cst_id").select(
        F.col("rows").alias("fact_rows"), (F.col("rows") - F.col("matched")).alias("orphan_customer_rows"))
    by_product = rows_by_key(fact, "sls_prd_key", products, "prd_key").select(
        F.col("rows").alias("_rows"), (F.col("rows") - F.col("matched")).alias("orphan_product_rows"))
    # one row on either side
    return by_customer.join(by_product, by_customer["fact_rows"] == by_product["_rows"]).drop("_rows")
