"""Raw CRM / ERP inputs derived from the driver's parquet tables.

The six raw files of the sales system are not available at scale, so each is
derived, row for row, from the order / line / customer / part / supplier tables,
with the kinds of dirt the cleaning layer exists for made by plain expressions on
the data (padding, codes in several spellings, null markers, ``.0`` keys, bad
compact dates, missing keys, future birth dates, version history, duplicate rows
and duplicate ids, costs with cents, fractional quantities and prices, ids above 2^53
that only the customer master has, ``.0`` and month-first dates, two-segment product
keys, unknown products, lines whose amount overflows). Sizes grow with the source tables:

================  =============================================  ==================
raw table         derived from                                   rows
================  =============================================  ==================
cust_info         orders x customer (a CRM snapshot per order)   one per order
prd_info          part, plus a second version for p_size > 25    ~1.5 per part
sales_details     lineitem x orders                              one per line
CUST_AZ12         customer, plus supplier ids (duplicate ids)    customers+suppliers
LOC_A101          customer x nation                              one per customer
PX_CAT_G1V2       distinct (type, name word) of part             small
================  =============================================  ==================

``sql_ctes()`` is the same derivation for DuckDB (the oracle side).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbeam import config
from starbeam.sources.csv_source import na_tokens_to_null
from starbeam.sources.testdata import balanced
from starbeam.sources.testdata import table as _table

FIRST_VERSION = dt.date(2010, 1, 1)
SECOND_VERSION = dt.date(2012, 7, 1)
BIRTH_EPOCH = dt.date(1940, 1, 1)
SUPPLIER_BIRTH_EPOCH = dt.date(1950, 1, 1)
FUTURE_BIRTH = "2030-05-05"
# Customers whose id the customer master writes as this much more (above 2^53).
LARGE_ID = 9007199254740992
HUGE_QUANTITY = "99999999999999"
UNKNOWN_PRODUCT = "9999-9999"


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A source table. ``spread`` marks the streamed (large) side of a derivation:
    it is spread over the cores when its file has too few splits, since every raw
    field is built by text expressions (heavy per-row work). Small sides that are
    broadcast are left as they are."""
    df = _table(spark, sf_dir, name)
    return balanced(df) if spread else df


def _s(c) -> F.Column:
    return c.cast("string")


def _case(key: F.Column, pairs, default) -> F.Column:
    out = None
    for k, v in pairs:
        v = F.lit(v) if not isinstance(v, F.Column) else v
        out = F.when(key == F.lit(k), v) if out is None else out.when(key == F.lit(k), v)
    return out.otherwise(default if isinstance(default, F.Column) else F.lit(default))


def _product_number(key: F.Column) -> F.Column:
    padded = F.lpad(_s(key), 8, "0")
    return F.concat(F.substring(padded, 1, 4), F.lit("-"), F.substring(padded, 5, 4))


def raw_cust_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", spread=True).select("o_custkey", "o_orderdate", "o_orderstatus",
                                                           "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
    key = _s(F.col("o_custkey"))
    large = _s(F.col("o_custkey") + F.lit(LARGE_ID))
    out = j.select(
        F.when(F.col("o_custkey") % 50 == 7, large)
        .when(F.col("o_orderpriority") == "1-URGENT", F.concat(key, F.lit(".0"))).otherwise(key).alias(" CST_ID"),
        F.concat(F.lit("CU"), F.lpad(key, 8, "0"), F.lit("-"), _s(F.year("o_orderdate"))).alias("Cst_Key "),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("cst_firstname"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("cst_lastname"),
        _case(F.col("o_orderstatus"), [("F", "S"), ("O", " m ")], "married").alias("cst_marital_status"),
        _case(F.col("c_mktsegment"), [("AUTOMOBILE", "M"), ("BUILDING", " f"), ("FURNITURE", "N/A"),
                                      ("HOUSEHOLD", "Female")], "x").alias("CST_GNDR"),
        _s(F.col("o_orderdate").cast("date")).alias("cst_create_date"),
    )
    return na_tokens_to_null(out)


def raw_prd_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice")
    versions = p.withColumn("ver", F.lit(1)).unionByName(
        p.where(F.col("p_size") > 25).withColumn("ver", F.lit(2)))
    size = F.col("p_size")
    first = F.col("ver") == 1
    start = F.when(first, F.date_add(F.lit(FIRST_VERSION), size)).otherwise(F.date_add(F.lit(SECOND_VERSION), size))
    end = F.when(first & (size > 25), F.date_add(F.lit(SECOND_VERSION), size - 1))
    cost = F.when(first & (size <= 2), F.lit(None).cast("string")).otherwise(
        _s(F.col("p_retailprice").cast("decimal(18,2)") - (F.lit(2) - F.col("ver")) * 10))
    category = [F.upper(F.substring("p_type", 1, 2)), F.upper(F.substring("p_name", 1, 2))]
    out = versions.select(
        _s(F.col("p_partkey") * 10 + F.col("ver")).alias("prd_id"),
        F.when(F.col("p_partkey") % 101 == 5, F.concat_ws("-", *category))
        .otherwise(F.concat_ws("-", *category, _product_number(F.col("p_partkey")))).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        cost.alias("prd_cost"),
        _case(F.substring("p_brand", 7, 1), [("1", "R "), ("2", "M "), ("3", "S "), ("4", "T ")],
              F.lit(None).cast("string")).alias("prd_line"),
        F.when(size == 3, F.date_format(start, "MM/dd/yyyy")).when(size == 4, F.lit("no date"))
        .otherwise(_s(start)).alias("prd_start_dt"),
        _s(end).alias("prd_end_dt"),
    )
    return na_tokens_to_null(out)


def raw_sales_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", spread=True).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                                 "l_extendedprice", "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "left")
    line = F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    out = j.select(
        F.concat(F.lit("SO"), _s(F.col("l_orderkey"))).alias("sls_ord_num"),
        F.when((F.col("l_returnflag") == "N") & (line == 6), F.lit(UNKNOWN_PRODUCT))
        .otherwise(_product_number(F.col("l_partkey"))).alias("sls_prd_key"),
        F.when((F.col("o_orderstatus") == "P") & (line == 3), F.lit(None).cast("string"))
        .otherwise(_s(F.col("o_custkey"))).alias("sls_cust_id"),
        F.when(line == 7, F.lit("0")).when(line == 5, F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".0")))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("sls_order_dt"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("sls_ship_dt"),
        F.date_format(F.date_add(F.col("l_shipdate").cast("date"), 7), "yyyyMMdd").alias("sls_due_dt"),
        _s((price * F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,4)")).alias("sls_sales"),
        F.when((F.col("l_orderkey") % 1000 == 7) & (line == 1), F.lit(HUGE_QUANTITY))
        .when((F.col("l_returnflag") == "A") & (line == 2), _s(F.col("l_quantity").cast("decimal(18,2)") + F.lit(0.5).cast("decimal(2,1)")))
        .otherwise(_s(F.col("l_quantity").cast("decimal(18,2)"))).alias("sls_quantity"),
        F.when((F.col("l_returnflag") == "R") & (line == 1), F.lit("n/a"))
        .when(line == 4, F.concat(_s(price), F.lit("5"))).otherwise(_s(price)).alias("sls_price"),
    )
    return na_tokens_to_null(out)


def raw_cust_az12(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    key = _s(F.col("c_custkey"))
    born = F.date_add(F.lit(BIRTH_EPOCH), (F.col("c_custkey") * 37 % 25000).cast("int"))
    cust = c.select(
        F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), F.concat(F.lit("NAS"), key))
        .otherwise(key).alias("CID"),
        F.when(F.col("c_nationkey") == 7, F.lit(FUTURE_BIRTH)).when(F.col("c_nationkey") == 11, F.lit("unknown day"))
        .when(F.col("c_nationkey") == 5, F.date_format(born, "MM/dd/yyyy")).otherwise(_s(born)).alias("BDATE"),
        _case(F.col("c_mktsegment"), [("AUTOMOBILE", "M"), ("BUILDING", "F "), ("FURNITURE", "n/a"),
                                      ("HOUSEHOLD", " Male")], F.lit(None).cast("string")).alias("GEN"),
    )
    supp = s.select(
        F.concat(F.lit("NAS"), _s(F.col("s_suppkey"))).alias("CID"),
        _s(F.date_add(F.lit(SUPPLIER_BIRTH_EPOCH), (F.col("s_suppkey") * 53 % 9000).cast("int"))).alias("BDATE"),
        F.when(F.col("s_nationkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("GEN"),
    )
    return na_tokens_to_null(cust.unionByName(supp))


COUNTRY_SPELLINGS = [(0, "DE"), (1, "US"), (2, "USA"), (3, " GB"), (4, "UK"), (5, "FR "), (6, "AU"),
                     (7, "CA"), (8, "  ")]


def raw_loc_a101(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    key = _s(F.col("c_custkey"))
    out = j.select(
        F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("NAS"), key)).otherwise(key).alias("cid"),
        F.when(F.col("c_nationkey") == 9, F.lit(None).cast("string"))
        .otherwise(_case(F.col("c_nationkey"), COUNTRY_SPELLINGS, F.col("n_name"))).alias("cntry"),
    )
    return na_tokens_to_null(out)


def raw_px_cat_g1v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_type", "p_name")
    out = p.select(
        F.concat(F.upper(F.substring("p_type", 1, 2)), F.lit("_"), F.upper(F.substring("p_name", 1, 2))).alias("ID"),
        F.col("p_type").alias("CAT"),
        F.when(F.col("p_type") == "PROMO", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), F.split_part("p_name", F.lit(" "), F.lit(1)))).alias("SUBCAT"),
        F.when(F.col("p_type").isin("LARGE", "MEDIUM"), F.lit("Yes")).otherwise(F.lit("No")).alias("MAINTENANCE"),
    ).distinct()
    return na_tokens_to_null(out)


RAW_BUILDERS = {
    "raw_cust_info": raw_cust_info,
    "raw_prd_info": raw_prd_info,
    "raw_sales_details": raw_sales_details,
    "raw_cust_az12": raw_cust_az12,
    "raw_loc_a101": raw_loc_a101,
    "raw_px_cat_g1v2": raw_px_cat_g1v2,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in RAW_BUILDERS.items()}


# ---------------------------------------------------------------------------
# DuckDB form of the same derivation.
# ---------------------------------------------------------------------------

def _na(expr: str) -> str:
    tokens = ", ".join("'" + t.replace("'", "''") + "'" for t in config.NA_TOKENS)
    return f"CASE WHEN ({expr}) IN ({tokens}) THEN NULL ELSE ({expr}) END"


def _pn(key: str) -> str:
    return f"concat(substr(lpad(CAST({key} AS VARCHAR), 8, '0'), 1, 4), '-', substr(lpad(CAST({key} AS VARCHAR), 8, '0'), 5, 4))"


def sql_ctes() -> str:
    """CTEs named raw_cust_info ... raw_px_cat_g1v2 with clean column names."""
    ck, ok = "CAST(c.c_custkey AS VARCHAR)", "CAST(o.o_custkey AS VARCHAR)"
    born = f"(DATE '{BIRTH_EPOCH}' + CAST(c.c_custkey * 37 % 25000 AS INTEGER))"
    start = f"(CASE WHEN ver = 1 THEN DATE '{FIRST_VERSION}' + p_size ELSE DATE '{SECOND_VERSION}' + p_size END)"
    cats = "concat(upper(substr(p_type, 1, 2)), '-', upper(substr(p_name, 1, 2)))"
    qty = "CAST(l.l_quantity AS DECIMAL(18,2))"
    country_case = " ".join(f"WHEN {k} THEN '{v}'" for k, v in COUNTRY_SPELLINGS)
    return f"""raw_cust_info AS (
  SELECT {_na(f"CASE WHEN o.o_custkey % 50 = 7 THEN CAST(o.o_custkey + {LARGE_ID} AS VARCHAR) WHEN o.o_orderpriority = '1-URGENT' THEN concat({ok}, '.0') ELSE {ok} END")} AS cst_id,
         {_na(f"concat('CU', lpad({ok}, 8, '0'), '-', CAST(year(o.o_orderdate) AS VARCHAR))")} AS cst_key,
         {_na("split_part(c.c_name, '#', 1)")} AS cst_firstname,
         {_na("split_part(c.c_name, '#', 2)")} AS cst_lastname,
         {_na("CASE o.o_orderstatus WHEN 'F' THEN 'S' WHEN 'O' THEN ' m ' ELSE 'married' END")} AS cst_marital_status,
         {_na("CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'M' WHEN 'BUILDING' THEN ' f' WHEN 'FURNITURE' THEN 'N/A' WHEN 'HOUSEHOLD' THEN 'Female' ELSE 'x' END")} AS cst_gndr,
         {_na("CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR)")} AS cst_create_date
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
raw_prd_versions AS (
  SELECT *, 1 AS ver FROM part UNION ALL SELECT *, 2 AS ver FROM part WHERE p_size > 25
),
raw_prd_info AS (
  SELECT {_na("CAST(p_partkey * 10 + ver AS VARCHAR)")} AS prd_id,
         {_na(f"CASE WHEN p_partkey % 101 = 5 THEN {cats} ELSE concat({cats}, '-', {_pn('p_partkey')}) END")} AS prd_key,
         {_na("p_name")} AS prd_nm,
         {_na("CASE WHEN ver = 1 AND p_size <= 2 THEN NULL ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) - (2 - ver) * 10 AS VARCHAR) END")} AS prd_cost,
         {_na("CASE substr(p_brand, 7, 1) WHEN '1' THEN 'R ' WHEN '2' THEN 'M ' WHEN '3' THEN 'S ' WHEN '4' THEN 'T ' ELSE NULL END")} AS prd_line,
         {_na(f"CASE p_size WHEN 3 THEN strftime({start}, '%m/%d/%Y') WHEN 4 THEN 'no date' ELSE CAST({start} AS VARCHAR) END")} AS prd_start_dt,
         {_na(f"CAST(CASE WHEN ver = 1 AND p_size > 25 THEN DATE '{SECOND_VERSION}' + (p_size - 1) END AS VARCHAR)")} AS prd_end_dt
  FROM raw_prd_versions
),
raw_sales_details AS (
  SELECT {_na("concat('SO', CAST(l.l_orderkey AS VARCHAR))")} AS sls_ord_num,
         {_na(f"CASE WHEN l.l_returnflag = 'N' AND l.l_linenumber = 6 THEN '{UNKNOWN_PRODUCT}' ELSE {_pn('l.l_partkey')} END")} AS sls_prd_key,
         {_na("CASE WHEN o.o_orderstatus = 'P' AND l.l_linenumber = 3 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END")} AS sls_cust_id,
         {_na("CASE WHEN l.l_linenumber = 7 THEN '0' WHEN l.l_linenumber = 5 THEN concat(strftime(o.o_orderdate, '%Y%m%d'), '.0') ELSE strftime(o.o_orderdate, '%Y%m%d') END")} AS sls_order_dt,
         {_na("strftime(l.l_shipdate, '%Y%m%d')")} AS sls_ship_dt,
         {_na("strftime(CAST(l.l_shipdate AS DATE) + 7, '%Y%m%d')")} AS sls_due_dt,
         {_na(f"CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * {qty} AS DECIMAL(18,4)) AS VARCHAR)")} AS sls_sales,
         {_na(f"CASE WHEN l.l_orderkey % 1000 = 7 AND l.l_linenumber = 1 THEN '{HUGE_QUANTITY}' WHEN l.l_returnflag = 'A' AND l.l_linenumber = 2 THEN CAST({qty} + CAST(0.5 AS DECIMAL(2,1)) AS VARCHAR) ELSE CAST({qty} AS VARCHAR) END")} AS sls_quantity,
         {_na("CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN 'n/a' WHEN l.l_linenumber = 4 THEN concat(CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '5') ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END")} AS sls_price
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
),
raw_cust_az12 AS (
  SELECT {_na(f"CASE WHEN c.c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN concat('NAS', {ck}) ELSE {ck} END")} AS cid,
         {_na(f"CASE c.c_nationkey WHEN 7 THEN '{FUTURE_BIRTH}' WHEN 11 THEN 'unknown day' WHEN 5 THEN strftime({born}, '%m/%d/%Y') ELSE CAST({born} AS VARCHAR) END")} AS bdate,
         {_na("CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'M' WHEN 'BUILDING' THEN 'F ' WHEN 'FURNITURE' THEN 'n/a' WHEN 'HOUSEHOLD' THEN ' Male' ELSE NULL END")} AS gen
  FROM customer c
  UNION ALL
  SELECT {_na("concat('NAS', CAST(s_suppkey AS VARCHAR))")},
         {_na(f"CAST(DATE '{SUPPLIER_BIRTH_EPOCH}' + CAST(s_suppkey * 53 % 9000 AS INTEGER) AS VARCHAR)")},
         {_na("CASE WHEN s_nationkey % 2 = 0 THEN 'F' ELSE 'M' END")}
  FROM supplier
),
raw_loc_a101 AS (
  SELECT {_na(f"CASE WHEN c.c_mktsegment = 'MACHINERY' THEN concat('NAS', {ck}) ELSE {ck} END")} AS cid,
         {_na(f"CASE WHEN c.c_nationkey = 9 THEN NULL ELSE CASE c.c_nationkey {country_case} ELSE n.n_name END END")} AS cntry
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw_px_cat_g1v2 AS (
  SELECT DISTINCT {_na("concat(upper(substr(p_type, 1, 2)), '_', upper(substr(p_name, 1, 2)))")} AS id,
         {_na("p_type")} AS cat,
         {_na("CASE WHEN p_type = 'PROMO' THEN NULL ELSE concat(' ', split_part(p_name, ' ', 1)) END")} AS subcat,
         {_na("CASE WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'Yes' ELSE 'No' END")} AS maintenance
  FROM part
)"""
