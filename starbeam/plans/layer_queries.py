"""Registered queries for the cleaning (CLN), dimension (DIM) and data-quality (DQ)
operators, run over the raw inputs derived from the test tables
(``sources.raw_adapter``), plus their DuckDB oracle SQL.

Money columns are returned as DOUBLE (exact DECIMAL inside), so both engines hand
over the same values.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbeam import config
from starbeam.config import Params
from starbeam.operators import cleaning, date_order, dimensions, quality, reports
from starbeam.operators.collation import collated_star
from starbeam.operators.distinct import rollup_distinct
from starbeam.operators.running import Over, running_over
from starbeam.plans import analytics, warehouse
from starbeam.session import apply_required_conf, ensure_checkpoint_dir
from starbeam.sources import raw_adapter, testdata
from starbeam.sources.csv_source import read_csv
from starbeam.sources.testdata import table

# ---------------------------------------------------------------- Spark side


class _Lazy(dict):
    """A dict whose values are built on first access."""

    def __init__(self, builders: dict):
        super().__init__()
        self._builders = builders

    def __missing__(self, key):
        value = self._builders[key]()
        self[key] = value
        return value

    def items(self):
        return [(k, self[k]) for k in self._builders]


class _Layers:
    """Bronze / silver / gold frames over one test-data directory, each built only
    when a query uses it."""

    def __init__(self, spark: SparkSession, sf_dir: str, p: Params):
        apply_required_conf(spark)
        self.p, self.spark, self.sf_dir = p, spark, sf_dir
        self.raw = _Lazy({name: (lambda fn=fn: fn(spark, sf_dir)) for name, fn in raw_adapter.RAW_BUILDERS.items()})
        self.silver = _Lazy({cleaning.CLEANERS[name][0]: (lambda name=name: cleaning.clean(
            name, self.raw[name], p.as_of)[1]) for name in raw_adapter.RAW_BUILDERS})

    def dim_customers(self) -> DataFrame:
        s = self.silver
        return dimensions.dim_customers(s["clean_cust_info"], s["clean_cust_az12"], s["clean_loc_a101"], self.p)

    def dim_products(self) -> DataFrame:
        return dimensions.dim_products(self.silver["clean_prd_info"], self.silver["clean_px_cat_g1v2"], self.p)

    def products(self) -> DataFrame:
        """Product dimension under the query names, without the surrogate key
        (for operators that do not use it: no key-assignment job)."""
        rows = dimensions.product_rows(self.silver["clean_prd_info"], self.silver["clean_px_cat_g1v2"], self.p)
        return warehouse.star_products_view(rows)

    def fact(self) -> DataFrame:
        return warehouse.fact_from_silver(self.silver["clean_sales_details"])

    def star(self):
        customers = self.dim_customers().select("cst_id", "cst_key", "cst_firstname", "cst_lastname",
                                                "cst_gndr", "cntry", "bdate")
        return warehouse.Star(fact=self.fact(), customers=customers, products=self.products())


def _dbl(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def _q(build):
    def make(p: Params):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(_Layers(spark, sf_dir, p))
        return run
    return make


def _cln16(L: _Layers) -> DataFrame:
    renamed = cleaning.normalise_headers(L.raw["raw_cust_info"]).withColumnsRenamed(
        {"cst_id": "customer_id", "cst_gndr": "gender", "cst_marital_status": "marital_status"})
    out = cleaning.clean_cust_info(renamed)
    return out.select("customer_id", "cst_key", "marital_status", "gender")


def _dq1(L: _Layers) -> DataFrame:
    return quality.union_all(quality.duplicates_removed(df, name) for name, df in L.raw.items())


def _dq7(L: _Layers) -> DataFrame:
    star = L.star()
    rc, rp = reports.customer_segments(star, L.p), reports.product_segments(star, L.p)
    return quality.segment_distribution(rc, "customer_segment", "cst_id", "report_customers").unionByName(
        quality.segment_distribution(rp, "product_segment", "prd_key", "report_products"))


def _running_orders(L: _Layers) -> DataFrame:
    """WN3-WN8 over all orders in time order: running sum and mean, rolling sum of seven orders, the order before."""
    orders = table(L.spark, L.sf_dir, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    out = running_over(orders, [F.asc("o_orderdate"), F.asc("o_orderkey")], [
        Over("running_price", "sum", "price"), Over("running_avg", "avg", "price"), Over("rolling_price", "sum", "price", 7), Over("previous_price", "lag", "price")])
    return _dbl(out, "price", "running_price", "rolling_price", "previous_price")


def _distinct_customers(L: _Layers) -> DataFrame:
    """AG4: distinct customers per month, year (month 0) and in all (year and month 0), from one scan."""
    dated = L.fact().where(F.col("sls_order_dt").isNotNull())
    fact = dated.select(F.year("sls_order_dt").alias("order_year"), F.month("sls_order_dt").alias("order_month"), "sls_cust_id")
    rolled = rollup_distinct(fact, ["order_year", "order_month"], "sls_cust_id", "customers")
    return rolled.select(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("order_year", "order_month")], "customers")


_SHIPPED = ("ship_day", "ship_month", "ship_points", "ship_unclear")


def _ship_texts(L: _Layers) -> DataFrame:
    """The ship dates of all lines as text: day-first with unreadable ones, month-first, with points, and without any vote."""
    lines = table(L.spark, L.sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("d"))
    texts = (F.when(F.col("l_linenumber") == 7, F.lit("n/k")).otherwise(F.date_format("d", "dd/MM/yyyy")), F.date_format("d", "MM-dd-yyyy"),
             F.date_format("d", "d.M.yyyy"), F.when(F.day("d") <= 12, F.date_format("d", "d/M/yyyy")).otherwise(F.col("d").cast("string")))
    return lines.select("l_orderkey", "l_linenumber", *[t.alias(name) for name, t in zip(_SHIPPED, texts, strict=True)])


#: Spellings of the product categories and keys in the collation queries: accents and capitals.
_PLAIN, _MARKED = "aeiouAEIOU", "áéíóúÁÉÍÓÚ"


def _spelled_star(L: _Layers):
    """The star with product keys and categories in several spellings: lines partly in capitals, products in small letters or with accents."""
    star = testdata.star(L.spark, L.sf_dir)
    key, marked = F.concat(F.lit("Item-"), F.col("prd_key").cast("string")), lambda c: F.translate(c, _PLAIN, _MARKED)
    kind = F.col("prd_key") % 3
    products = star.products.select(
        F.when(kind == 0, F.lower(key)).when(kind == 1, marked(key)).otherwise(key).alias("prd_key"), "prd_nm",
        F.when(kind == 0, F.lower("cat")).when(kind == 1, marked(F.col("cat"))).otherwise(F.col("cat")).alias("cat"), "subcat", "prd_cost")
    of_line = F.concat(F.when(F.col("sls_prd_key") % 2 == 0, F.lit("ITEM-")).otherwise(F.lit("Item-")), F.col("sls_prd_key").cast("string"))
    return warehouse.Star(fact=star.fact.withColumn("sls_prd_key", of_line), customers=star.customers, products=products,
                          lines=star.lines.withColumn("sls_prd_key", of_line))


def _collated_revenue(collation: str | None):
    """Q12 over the spelled star: joins, groups and order with and without a collation."""
    def build(L: _Layers) -> DataFrame:
        star = _spelled_star(L)
        found = analytics.q12_revenue_by_category(collated_star(star, collation) if collation else star, L.p)
        return found.withColumn("category", F.collate("category", "UTF8_BINARY"))
    return build


def _src1(L: _Layers) -> DataFrame:
    """SRC1: products written as CSV with quotes, commas and line breaks in a field, and read back."""
    part = table(L.spark, L.sf_dir, "part")
    name = F.concat(F.lit('say "'), F.col("p_name"), F.lit('", then\n'), F.col("p_brand"))
    path = f"{ensure_checkpoint_dir(L.spark)}/csv-{uuid.uuid4().hex}"
    part.select("p_partkey", name.alias("p_text"), "p_type").write.options(header="true", escape='"', quoteAll="true").csv(path)
    return read_csv(L.spark, path)


_SALES_MONEY = ("sls_quantity", "sls_sales", "sls_price", "sales_amount")

BUILDERS = {
    "ag04_distinct_rollup": _distinct_customers,
    "wn03_running_orders": _running_orders,
    "cln01_header_normalise": lambda L: cleaning.normalise_headers(L.raw["raw_cust_info"]),
    "cln02_exact_dedup": lambda L: cleaning.drop_exact_duplicates(cleaning.normalise_headers(L.raw["raw_cust_info"])),
    "cln03_recode_gender": lambda L: L.silver["clean_cust_info"].select("cst_id", "cst_key", "cst_gndr"),
    "cln04_recode_marital": lambda L: L.silver["clean_cust_info"].select("cst_id", "cst_key", "cst_marital_status"),
    "cln05_integer_key": lambda L: L.silver["clean_cust_info"].select("cst_key", "cst_id"),
    "cln06_numeric_fill_zero": lambda L: _dbl(L.silver["clean_sales_details"].select(
        "sls_ord_num", "sls_prd_key", "sls_quantity", "sls_price", "sls_sales"), "sls_quantity", "sls_price", "sls_sales"),
    "cln07_split_product_key": lambda L: L.silver["clean_prd_info"].select("prd_id", "prd_key", "cat_id"),
    "cln08_coerce_dates": lambda L: L.silver["clean_prd_info"].select("prd_id", "prd_start_dt", "prd_end_dt"),
    "cln08_date_votes": lambda L: date_order.vote(_ship_texts(L), _SHIPPED),
    "cln08_dates_by_vote": lambda L: date_order.read_by_vote(_ship_texts(L), _SHIPPED),
    "jn01_collated_revenue": _collated_revenue("UNICODE_CI_AI"),
    "jn01_bytewise_revenue": _collated_revenue(None),
    "cln09_parse_compact_dates": lambda L: L.silver["clean_sales_details"].select(
        "sls_ord_num", "sls_prd_key", "sls_order_dt", "sls_ship_dt", "sls_due_dt"),
    "cln10_sales_amount": lambda L: _dbl(L.silver["clean_sales_details"].select(
        "sls_ord_num", "sls_prd_key", "sls_quantity", "sls_price", "sales_amount"), "sls_quantity", "sls_price", "sales_amount"),
    "cln11_drop_null_keys": lambda L: _dbl(L.silver["clean_sales_details"], *_SALES_MONEY),
    "cln12_future_dates": lambda L: L.silver["clean_cust_az12"].select("cid", "bdate"),
    "cln13_recode_erp_gender": lambda L: L.silver["clean_cust_az12"].select("cid", "gen"),
    "cln14_country": lambda L: L.silver["clean_loc_a101"],
    "cln15_fill_text": lambda L: L.silver["clean_px_cat_g1v2"],
    "cln16_schema_tolerant": _cln16,
    "dim01_keep_latest_customer": lambda L: dimensions.keep_latest_customer(L.silver["clean_cust_info"]),
    "dim02_keep_first_by_key": lambda L: dimensions.keep_first_by_key(
        dimensions.normalise_erp_key(L.silver["clean_cust_az12"], "cid"), "cid"),
    "dim03_normalise_erp_key": lambda L: dimensions.normalise_erp_key(L.silver["clean_cust_az12"], "cid"),
    "dim04_dim_customers": lambda L: L.dim_customers(),
    "dim04_join_key_rates": lambda L: dimensions.join_key_rates(L.silver["clean_cust_info"], L.silver["clean_cust_az12"]),
    "dim05_match_rate": lambda L: dimensions.customer_match_rate(L.dim_customers()),
    "dim06_active_products": lambda L: _dbl(dimensions.active_products(L.silver["clean_prd_info"]), "prd_cost"),
    "dim07_latest_versions": lambda L: _dbl(dimensions.latest_product_versions(L.silver["clean_prd_info"]),
                                            "prd_cost"),
    "dim08_attach_categories": lambda L: _dbl(dimensions.attach_categories(
        dimensions.latest_product_versions(L.silver["clean_prd_info"]), L.silver["clean_px_cat_g1v2"]),
        "prd_cost"),
    "dim09_product_surrogate_key": lambda L: _dbl(L.dim_products(), "cost"),
    "dim10_product_line_decode": lambda L: dimensions.latest_product_versions(L.silver["clean_prd_info"]).select(
        "prd_key", "prd_line", dimensions.decode_product_line("prd_line").alias("product_line")),
    "dim11_dim_date": lambda L: dimensions.dim_date(L.fact()),
    "dim13_fact_sales": lambda L: _dbl(L.fact(), *_SALES_MONEY),
    "dim14_profit": lambda L: _dbl(dimensions.add_profit(
        L.fact(), L.products(), L.p).select(
        "sls_ord_num", "sls_prd_key", "sls_quantity", "sales_amount", "profit"), "sls_quantity", "sales_amount", "profit"),
    "dim15_fact_totals": lambda L: dimensions.fact_totals(L.fact()),
    "dim16_orphans": lambda L: dimensions.orphan_counts(
        L.fact(), L.dim_customers(), L.products()),
    "dim17_date_range": lambda L: dimensions.date_range(dimensions.dim_date(L.fact())),
    "dq1_duplicates_removed": _dq1,
    "dq2_null_key_rows": lambda L: quality.null_key_rows(L.raw["raw_sales_details"]),
    "dq3_future_dates": lambda L: quality.future_dates(L.raw["raw_cust_az12"], L.p.as_of),
    "dq4_orphans": lambda L: quality.orphans(L.fact(), L.dim_customers(), L.products()),
    "dq5_match_rate": lambda L: quality.match_rate(L.dim_customers()),
    "dq6_nonempty_join": lambda L: quality.nonempty_join(L.fact(), L.products()),
    "dq7_segment_distribution": _dq7,
    "dq9_values_lost": lambda L: quality.values_lost(L.silver["clean_sales_details"], L.silver["clean_prd_info"]),
    "dq10_values_lost_by_rule": lambda L: quality.values_lost_by_rule(L.raw, L.p.as_of),
    "src1_csv_scan": _src1,
}


def queries(p: Params) -> dict:
    return {name: _q(build)(p) for name, build in BUILDERS.items()}


# ---------------------------------------------------------------- DuckDB side

WS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"


def _strip(x: str) -> str:
    return f"trim({x}, {WS})"


def _recode(x: str, mapping: dict, nulls=()) -> str:
    k = f"upper({_strip(x)})"
    parts = []
    if nulls:
        parts.append(f"WHEN {k} IN ({', '.join(repr(n) for n in nulls)}) THEN NULL")
    parts += [f"WHEN {k} = '{a}' THEN '{b}'" for a, b in mapping.items()]
    return f"CASE {' '.join(parts)} ELSE {k} END"


def _try_int(x: str) -> str:
    t = f"trim(CAST({x} AS VARCHAR))"
    return (f"CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+([.]0*)?') "
            f"THEN TRY_CAST(regexp_replace({t}, '[.]0*$', '') AS BIGINT) END")


def _money0(x: str) -> str:
    return f"COALESCE(TRY_CAST({_strip(x)} AS DECIMAL(18,4)), CAST(0 AS DECIMAL(18,4)))"


def _date(x: str) -> str:
    forms = ", ".join(f"CAST(TRY_STRPTIME(trim({x}), '{f}') AS DATE)" for f in ("%m/%d/%Y", "%Y/%m/%d"))
    return f"COALESCE(CAST(TRY_CAST(trim({x}) AS TIMESTAMP) AS DATE), {forms})"


def _compact(x: str) -> str:
    t = f"regexp_replace(trim({x}), '[.]0*$', '')"
    return f"CASE WHEN regexp_full_match({t}, '[0-9]{{8}}') THEN CAST(TRY_STRPTIME({t}, '%Y%m%d') AS DATE) END"


def _line_decode(x: str) -> str:
    k = f"upper({_strip(x)})"
    whens = " ".join(f"WHEN {k} = '{a}' THEN '{b}'" for a, b in config.PRODUCT_LINES.items())
    return f"CASE {whens} ELSE '{config.PRODUCT_LINE_MISSING}' END"


def _first(table: str, key: str, order: str) -> str:
    return (f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
            f"FROM {table}) z WHERE rn = 1)")


def _countries(x: str) -> str:
    s = _strip(x)
    whens = " ".join(f"WHEN {s} = '{a}' THEN '{b}'" for a, b in config.COUNTRY_CODES.items())
    return f"CASE WHEN {s} IS NULL OR {s} = '' THEN 'Unknown' {whens} ELSE {s} END"


def silver_ctes(p: Params) -> str:
    g = config.GENDER_CODES
    return f"""clean_cust_info AS (
  SELECT {_try_int('cst_id')} AS cst_id, cst_key, cst_firstname, cst_lastname,
         {_recode('cst_marital_status', config.MARITAL_CODES)} AS cst_marital_status,
         {_recode('cst_gndr', g, config.GENDER_NULL_CODES)} AS cst_gndr, cst_create_date
  FROM (SELECT DISTINCT * FROM raw_cust_info) d
),
clean_prd_info AS (
  SELECT {_try_int('prd_id')} AS prd_id,
         array_to_string(string_split(prd_key, '-')[3:], '-') AS prd_key,
         prd_nm, {_money0('prd_cost')} AS prd_cost, prd_line,
         {_date('prd_start_dt')} AS prd_start_dt, {_date('prd_end_dt')} AS prd_end_dt,
         array_to_string(string_split(prd_key, '-')[1:2], '_') AS cat_id
  FROM (SELECT DISTINCT * FROM raw_prd_info) d
),
clean_sales_details AS (
  SELECT * FROM (
    SELECT sls_ord_num, sls_prd_key, {_try_int('sls_cust_id')} AS sls_cust_id,
           {_compact('sls_order_dt')} AS sls_order_dt, {_compact('sls_ship_dt')} AS sls_ship_dt,
           {_compact('sls_due_dt')} AS sls_due_dt,
           {_money0('sls_sales')} AS sls_sales, {_money0('sls_quantity')} AS sls_quantity,
           {_money0('sls_price')} AS sls_price,
           TRY_CAST(CAST({_money0('sls_quantity')} AS DECIMAL(20,4)) * {_money0('sls_price')} AS DECIMAL(20,4)) AS sales_amount
    FROM (SELECT DISTINCT * FROM raw_sales_details) d
  ) x WHERE sls_ord_num IS NOT NULL AND sls_prd_key IS NOT NULL AND sls_cust_id IS NOT NULL
),
clean_cust_az12 AS (
  SELECT cid, CASE WHEN {_date('bdate')} <= DATE '{p.as_of.isoformat()}' THEN {_date('bdate')} END AS bdate,
         {_recode('gen', g, config.GENDER_NULL_CODES)} AS gen
  FROM (SELECT DISTINCT * FROM raw_cust_az12) d
),
clean_loc_a101 AS (
  SELECT cid, {_countries('cntry')} AS cntry FROM (SELECT DISTINCT * FROM raw_loc_a101) d
),
clean_px_cat_g1v2 AS (
  SELECT id, {_strip("COALESCE(cat, 'Unknown')")} AS cat, {_strip("COALESCE(subcat, 'Unknown')")} AS subcat,
         {_strip("COALESCE(maintenance, 'Unknown')")} AS maintenance
  FROM (SELECT DISTINCT * FROM raw_px_cat_g1v2) d
)"""


def gold_ctes() -> str:
    crm_order = ("cst_key DESC NULLS LAST, cst_firstname ASC NULLS FIRST, cst_lastname ASC NULLS FIRST, "
                 "cst_marital_status ASC NULLS FIRST, cst_gndr ASC NULLS FIRST, cst_create_date ASC NULLS FIRST")
    prd_order = ("prd_start_dt DESC NULLS LAST, prd_id ASC NULLS FIRST, prd_nm ASC NULLS FIRST, "
                 "prd_cost ASC NULLS FIRST, prd_line ASC NULLS FIRST, prd_end_dt ASC NULLS FIRST, cat_id ASC NULLS FIRST")
    nas = _strip("replace(CAST(cid AS VARCHAR), 'NAS', '')")
    return f"""norm_cust_az12 AS (SELECT {nas} AS cid, bdate, gen FROM clean_cust_az12),
crm AS {_first('clean_cust_info', 'cst_id', crm_order)},
demo AS {_first('norm_cust_az12', 'cid', 'bdate ASC NULLS FIRST, gen ASC NULLS FIRST')},
loc AS {_first(f'(SELECT {nas} AS cid, cntry FROM clean_loc_a101)', 'cid', 'cntry ASC NULLS FIRST')},
dim_customers AS (
  SELECT crm.*, demo.cid, demo.bdate, demo.gen, loc.cid AS loc_cid, loc.cntry
  FROM crm LEFT JOIN demo ON CAST(crm.cst_id AS VARCHAR) = demo.cid
           LEFT JOIN loc ON CAST(crm.cst_id AS VARCHAR) = loc.cid
),
latest_prd AS {_first('clean_prd_info', 'prd_key', prd_order)},
cats AS {_first(f"(SELECT {_strip('id')} AS _cat_id, cat, subcat, maintenance FROM clean_px_cat_g1v2)", '_cat_id',
                'cat ASC NULLS FIRST, subcat ASC NULLS FIRST, maintenance ASC NULLS FIRST')},
prd_with_cat AS (
  SELECT l.*, c.cat, c.subcat, c.maintenance FROM latest_prd l LEFT JOIN cats c ON {_strip('l.cat_id')} = c._cat_id
),
dim_products AS (
  SELECT row_number() OVER (ORDER BY start_date NULLS FIRST, product_number NULLS FIRST, product_id NULLS FIRST)
           AS product_key, *
  FROM (SELECT prd_id AS product_id, prd_key AS product_number, prd_nm AS product_name, cat_id AS category_id,
               cat AS category, subcat AS subcategory, maintenance, prd_cost AS cost,
               {_line_decode('prd_line')} AS product_line, prd_start_dt AS start_date
        FROM prd_with_cat) x
),
star_products AS (
  SELECT product_number AS prd_key, product_name AS prd_nm, category AS cat, subcategory AS subcat,
         cost AS prd_cost FROM dim_products
),
fact AS (
  SELECT sls_ord_num, sls_prd_key, sls_cust_id, sls_order_dt, sls_ship_dt, sls_due_dt, sls_quantity,
         sls_price, sls_sales, sales_amount FROM clean_sales_details
),
dim_date AS (
  SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
         CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name,
         CAST(weekofyear(date) AS INTEGER) AS week, CAST(day(date) AS INTEGER) AS day,
         dayname(date) AS weekday, dayname(date) IN ('Saturday', 'Sunday') AS is_weekend
  FROM (SELECT DISTINCT sls_order_dt AS date FROM fact WHERE sls_order_dt IS NOT NULL) d
)"""


def _dq_rows(check_id: str, name: str, table: str, source: str, metrics: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{check_id}' AS check_id, '{name}' AS check_name, '{table}' AS table_name, '{m}' AS metric, "
        f"CAST({expr} AS BIGINT) AS value FROM {source}" for m, expr in metrics)


def _losses(p: Params) -> str:
    """DQ10: per raw table, one aggregate with a missing and a lost count per parsed column."""
    amount = f"TRY_CAST(CAST({_money0('sls_quantity')} AS DECIMAL(20,4)) * {_money0('sls_price')} AS DECIMAL(20,4))"
    money = lambda x: f"TRY_CAST({_strip(x)} AS DECIMAL(18,4))"
    reads = {
        "raw_cust_info": ("clean_cust_info", [("CLN5", "cst_id", _try_int, "null")], []),
        "raw_prd_info": ("clean_prd_info", [("CLN6", "prd_cost", money, "zero"), ("CLN8", "prd_start_dt", _date, "null"), ("CLN8", "prd_end_dt", _date, "null")],
                         [("CLN7_prd_key_short", "len(string_split(prd_key, '-')) < 3")]),
        "raw_sales_details": ("clean_sales_details", [
            *[("CLN9", c, _compact, "null") for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
            *[("CLN6", c, money, "zero") for c in ("sls_quantity", "sls_price", "sls_sales")], ("CLN5", "sls_cust_id", _try_int, "null")],
            [("CLN10_sales_amount_overflow", f"{amount} IS NULL")]),
        "raw_cust_az12": ("clean_cust_az12", [("CLN8", "bdate", _date, "null")], [("CLN12_bdate_future", f"{_date('bdate')} > DATE '{p.as_of.isoformat()}'")]),
    }
    parts = []
    for raw, (target, columns, more) in reads.items():
        found = list(more)
        for rule, c, read, instead in columns:
            present = f"COALESCE({_strip(f'CAST({c} AS VARCHAR)')} <> '', FALSE)"
            found += [(f"{rule}_{c}_missing", f"NOT {present}"), (f"{rule}_{c}_{instead}", f"{present} AND {read(c)} IS NULL")]
        counts = ", ".join(f"COUNT(*) FILTER (WHERE {condition}) AS {m}" for m, condition in found)
        parts.append(_dq_rows("DQ10", "values_lost_by_rule", target, f"(SELECT {counts} FROM (SELECT DISTINCT * FROM {raw}) d) q", [(m, m) for m, _ in found]))
    return " UNION ALL ".join(parts)


_SHIP_SQL = "shipped AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d FROM lineitem)"


def _votes_sql() -> str:
    """The votes of the four text columns, each from its texts."""
    day = "(CAST(day(d) AS VARCHAR) || '/' || CAST(month(d) AS VARCHAR) || '/' || CAST(year(d) AS VARCHAR))"
    texts = {"ship_day": "CASE WHEN l_linenumber = 7 THEN 'n/k' ELSE strftime(d, '%d/%m/%Y') END", "ship_month": "strftime(d, '%m-%d-%Y')",
             "ship_points": f"replace({day}, '/', '.')", "ship_unclear": f"CASE WHEN day(d) <= 12 THEN {day} ELSE CAST(d AS VARCHAR) END"}
    numbers = "replace(replace(t, '.', '/'), '-', '/')"
    parts = []
    for name, text in texts.items():
        kinds = f"""SELECT TRY_CAST(t AS DATE) IS NOT NULL AND t LIKE '____-%' AS y, TRY_STRPTIME({numbers}, '%d/%m/%Y') IS NOT NULL AS dd,
  TRY_STRPTIME({numbers}, '%m/%d/%Y') IS NOT NULL AS mm, t IS NULL AS none FROM (SELECT {text} AS t FROM shipped) x"""
        parts.append(f"""SELECT '{name}' AS column_name, COUNT(*) FILTER (WHERE none) AS missing, COUNT(*) FILTER (WHERE y) AS year_first,
  COUNT(*) FILTER (WHERE NOT y AND dd AND NOT mm) AS day_first, COUNT(*) FILTER (WHERE NOT y AND mm AND NOT dd) AS month_first,
  COUNT(*) FILTER (WHERE NOT y AND dd AND mm) AS either, COUNT(*) FILTER (WHERE NOT none AND NOT y AND NOT dd AND NOT mm) AS unreadable FROM ({kinds}) k""")
    return f"""WITH {_SHIP_SQL}, votes AS ({' UNION ALL '.join(parts)})
SELECT *, CASE WHEN day_first > month_first THEN 'day' ELSE 'month' END AS date_form, either > 0 AND day_first = month_first AS ambiguous FROM votes"""


_SPELLED_SQL = f"""{testdata.SQL_STAR}, spelled_products AS (
  SELECT CASE prd_key % 3 WHEN 0 THEN lower('Item-' || prd_key) WHEN 1 THEN translate('Item-' || prd_key, '{_PLAIN}', '{_MARKED}') ELSE 'Item-' || prd_key END AS prd_key,
         CASE prd_key % 3 WHEN 0 THEN lower(cat) WHEN 1 THEN translate(cat, '{_PLAIN}', '{_MARKED}') ELSE cat END AS cat FROM dim_products
), spelled_fact AS (SELECT CASE WHEN sls_prd_key % 2 = 0 THEN 'ITEM-' ELSE 'Item-' END || sls_prd_key AS sls_prd_key, sales_amount FROM fact_sales)"""


def oracle_sql(p: Params) -> dict[str, str]:
    from starbeam.plans.oracle import report_customers_cte, report_products_cte

    head = "WITH " + raw_adapter.sql_ctes() + ",\n" + silver_ctes(p) + ",\n" + gold_ctes()
    money = "CAST(sls_quantity AS DOUBLE) AS sls_quantity, CAST(sls_sales AS DOUBLE) AS sls_sales, CAST(sls_price AS DOUBLE) AS sls_price, " \
            "CAST(sales_amount AS DOUBLE) AS sales_amount"
    dq1 = " UNION ALL ".join(
        _dq_rows("DQ1", "duplicates_removed", t,
                 f"(SELECT (SELECT COUNT(*) FROM {t}) AS n, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {t}) d) AS m) q",
                 [("rows_in", "n"), ("rows_out", "m"), ("rows_removed", "n - m")])
        for t in raw_adapter.RAW_BUILDERS)
    staged_sales = f"(SELECT sls_ord_num, sls_prd_key, {_try_int('sls_cust_id')} AS sls_cust_id FROM (SELECT DISTINCT * FROM raw_sales_details) d)"
    star = ("fact_sales AS (SELECT * FROM fact), dim_customers_star AS (SELECT cst_id, cst_key, cst_firstname, "
            "cst_lastname, cst_gndr, cntry, bdate FROM dim_customers)")
    rc = report_customers_cte(p, customers="dim_customers_star")
    rp = report_products_cte(p, products="star_products")
    orphan_src = """(SELECT (SELECT COUNT(*) FROM fact) AS fact_rows,
  (SELECT COUNT(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dim_customers c WHERE c.cst_id = f.sls_cust_id)) AS oc,
  (SELECT COUNT(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM star_products s WHERE s.prd_key = f.sls_prd_key)) AS op) q"""
    return {
        "cln01_header_normalise": f"{head} SELECT * FROM raw_cust_info",
        "cln02_exact_dedup": f"{head} SELECT DISTINCT * FROM raw_cust_info",
        "cln03_recode_gender": f"{head} SELECT cst_id, cst_key, cst_gndr FROM clean_cust_info",
        "cln04_recode_marital": f"{head} SELECT cst_id, cst_key, cst_marital_status FROM clean_cust_info",
        "cln05_integer_key": f"{head} SELECT cst_key, cst_id FROM clean_cust_info",
        "cln06_numeric_fill_zero": f"""{head} SELECT sls_ord_num, sls_prd_key, CAST(sls_quantity AS DOUBLE) AS sls_quantity,
  CAST(sls_price AS DOUBLE) AS sls_price, CAST(sls_sales AS DOUBLE) AS sls_sales FROM clean_sales_details""",
        "cln07_split_product_key": f"{head} SELECT prd_id, prd_key, cat_id FROM clean_prd_info",
        "cln08_coerce_dates": f"{head} SELECT prd_id, prd_start_dt, prd_end_dt FROM clean_prd_info",
        "cln09_parse_compact_dates": f"""{head} SELECT sls_ord_num, sls_prd_key, sls_order_dt, sls_ship_dt, sls_due_dt
FROM clean_sales_details""",
        "cln10_sales_amount": f"""{head} SELECT sls_ord_num, sls_prd_key, CAST(sls_quantity AS DOUBLE) AS sls_quantity, CAST(sls_price AS DOUBLE) AS sls_price,
  CAST(sales_amount AS DOUBLE) AS sales_amount FROM clean_sales_details""",
        "cln11_drop_null_keys": f"""{head} SELECT sls_ord_num, sls_prd_key, sls_cust_id, sls_order_dt, sls_ship_dt,
  sls_due_dt, {money} FROM clean_sales_details""",
        "cln12_future_dates": f"{head} SELECT cid, bdate FROM clean_cust_az12",
        "cln13_recode_erp_gender": f"{head} SELECT cid, gen FROM clean_cust_az12",
        "cln14_country": f"{head} SELECT * FROM clean_loc_a101",
        "cln15_fill_text": f"{head} SELECT * FROM clean_px_cat_g1v2",
        "cln16_schema_tolerant": f"""{head} SELECT cst_id AS customer_id, cst_key, cst_marital_status AS marital_status,
  cst_gndr AS gender FROM clean_cust_info""",
        "dim01_keep_latest_customer": f"{head} SELECT * FROM crm",
        "dim02_keep_first_by_key": f"{head} SELECT * FROM demo",
        "dim03_normalise_erp_key": f"{head} SELECT * FROM norm_cust_az12",
        "dim04_dim_customers": f"{head} SELECT * FROM dim_customers",
        "cln08_date_votes": _votes_sql(),
        "cln08_dates_by_vote": f"""WITH {_SHIP_SQL} SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 THEN d END AS ship_day, d AS ship_month, d AS ship_points,
  CASE WHEN day(d) <= 12 THEN make_date(year(d), day(d), month(d)) ELSE d END AS ship_unclear FROM shipped""",
        "jn01_collated_revenue": f"""{_SPELLED_SQL} SELECT MIN(pr.cat) AS category, CAST(SUM(f.sales_amount) AS DOUBLE) AS total_revenue
FROM spelled_fact f LEFT JOIN spelled_products pr ON lower(f.sls_prd_key) = lower(strip_accents(pr.prd_key)) GROUP BY lower(strip_accents(pr.cat))
ORDER BY total_revenue DESC""",
        "jn01_bytewise_revenue": f"""{_SPELLED_SQL} SELECT pr.cat AS category, CAST(SUM(f.sales_amount) AS DOUBLE) AS total_revenue
FROM spelled_fact f LEFT JOIN spelled_products pr ON f.sls_prd_key = pr.prd_key GROUP BY pr.cat ORDER BY total_revenue DESC""",
        "ag04_distinct_rollup": f"""{head} SELECT COALESCE(order_year, 0) AS order_year, COALESCE(order_month, 0) AS order_month, COUNT(DISTINCT sls_cust_id) AS customers
FROM (SELECT YEAR(sls_order_dt) AS order_year, MONTH(sls_order_dt) AS order_month, sls_cust_id FROM fact WHERE sls_order_dt IS NOT NULL) t
GROUP BY ROLLUP (order_year, order_month)""",
        "wn03_running_orders": """SELECT o_orderkey, o_orderdate, CAST(price AS DOUBLE) AS price, CAST(SUM(price) OVER w AS DOUBLE) AS running_price,
  CAST(SUM(price) OVER w AS DOUBLE) / COUNT(price) OVER w AS running_avg,
  CAST(SUM(price) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rolling_price,
  CAST(LAG(price) OVER w AS DOUBLE) AS previous_price
FROM (SELECT o_orderkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders) t
WINDOW w AS (ORDER BY o_orderdate, o_orderkey)""",
        "dim04_join_key_rates": f"""{head}, keys AS (
  SELECT 'cst_id' AS join_key, CAST(cst_id AS VARCHAR) AS k FROM crm UNION ALL SELECT 'cst_key', TRIM(REPLACE(cst_key, 'NAS', '')) FROM crm)
SELECT join_key, COUNT(*) AS customers, COUNT(*) FILTER (WHERE k IN (SELECT cid FROM norm_cust_az12 WHERE cid IS NOT NULL)) AS matched,
  ROUND(CAST(COUNT(*) FILTER (WHERE k IN (SELECT cid FROM norm_cust_az12 WHERE cid IS NOT NULL)) AS DOUBLE) / COUNT(*), 4) AS match_rate
FROM keys GROUP BY join_key""",
        "dim05_match_rate": f"""{head} SELECT rows_after_merge, rows_matched,
  ROUND(CAST(rows_matched AS DOUBLE) / rows_after_merge, 4) AS match_rate
FROM (SELECT COUNT(*) AS rows_after_merge, COUNT(*) FILTER (WHERE cid IS NOT NULL) AS rows_matched FROM dim_customers) t""",
        "dim06_active_products": f"""{head} SELECT * REPLACE (CAST(prd_cost AS DOUBLE) AS prd_cost)
FROM clean_prd_info WHERE prd_end_dt IS NULL""",
        "dim07_latest_versions": f"{head} SELECT * REPLACE (CAST(prd_cost AS DOUBLE) AS prd_cost) FROM latest_prd",
        "dim08_attach_categories": f"{head} SELECT * REPLACE (CAST(prd_cost AS DOUBLE) AS prd_cost) FROM prd_with_cat",
        "dim09_product_surrogate_key": f"{head} SELECT * REPLACE (CAST(cost AS DOUBLE) AS cost) FROM dim_products",
        "dim10_product_line_decode": f"""{head} SELECT prd_key, prd_line, {_line_decode('prd_line')} AS product_line
FROM latest_prd""",
        "dim11_dim_date": f"{head} SELECT * FROM dim_date",
        "dim13_fact_sales": f"""{head} SELECT sls_ord_num, sls_prd_key, sls_cust_id, sls_order_dt, sls_ship_dt, sls_due_dt,
  {money} FROM fact""",
        "dim14_profit": f"""{head} SELECT f.sls_ord_num, f.sls_prd_key, CAST(f.sls_quantity AS DOUBLE) AS sls_quantity,
  CAST(f.sales_amount AS DOUBLE) AS sales_amount,
  CAST(TRY_CAST(f.sales_amount - s.prd_cost * CAST(f.sls_quantity AS DECIMAL(20,4)) AS DECIMAL(20,4)) AS DOUBLE) AS profit
FROM fact f LEFT JOIN star_products s ON s.prd_key = f.sls_prd_key""",
        "dim15_fact_totals": f"""{head} SELECT CAST(SUM(sales_amount) AS DOUBLE) AS total_revenue,
  COUNT(*) AS total_rows FROM fact""",
        "dim16_orphans": f"""{head} SELECT fact_rows, oc AS orphan_customer_rows, op AS orphan_product_rows
FROM {orphan_src}""",
        "dim17_date_range": f"{head} SELECT MIN(date) AS min_date, MAX(date) AS max_date FROM dim_date",
        "dq1_duplicates_removed": f"{head} {dq1}",
        "dq2_null_key_rows": f"""{head} {_dq_rows('DQ2', 'null_key_rows_dropped', 'clean_sales_details',
            f"(SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE sls_ord_num IS NULL OR sls_prd_key IS NULL OR sls_cust_id IS NULL) AS dropped FROM {staged_sales} s) q",
            [('rows_in', 'n'), ('rows_dropped', 'dropped')])}""",
        "dq3_future_dates": f"""{head} {_dq_rows('DQ3', 'future_birthdates_nulled', 'clean_cust_az12',
            f"(SELECT COUNT(*) FILTER (WHERE b > DATE '{p.as_of.isoformat()}') AS future, COUNT(*) FILTER (WHERE b IS NULL) AS bad FROM (SELECT {_date('bdate')} AS b FROM (SELECT DISTINCT * FROM raw_cust_az12) d) x) q",
            [('future_dates', 'future'), ('unparseable_or_missing', 'bad')])}""",
        "dq4_orphans": f"""{head} {_dq_rows('DQ4', 'orphan_fact_rows', 'fact_sales', orphan_src,
            [('fact_rows', 'fact_rows'), ('orphan_customer_rows', 'oc'), ('orphan_product_rows', 'op')])}""",
        "dq5_match_rate": f"""{head} {_dq_rows('DQ5', 'customer_erp_match', 'dim_customers',
            "(SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE cid IS NOT NULL) AS m FROM dim_customers) q",
            [('rows_after_merge', 'n'), ('rows_matched', 'm')])}""",
        "dq6_nonempty_join": f"""{head} {_dq_rows('DQ6', 'sales_product_join_nonempty', 'report_products',
            "(SELECT COUNT(*) AS n FROM fact f WHERE f.sls_order_dt IS NOT NULL AND EXISTS (SELECT 1 FROM star_products s WHERE s.prd_key = f.sls_prd_key)) q",
            [('matched_rows', 'n'), ('passed', 'CASE WHEN n > 0 THEN 1 ELSE 0 END')])}""",
        "dq9_values_lost": f"""{head} {_dq_rows('DQ9', 'values_lost', 'clean_sales_details',
            "(SELECT COUNT(*) FILTER (WHERE sales_amount IS NULL) AS o, COUNT(*) FILTER (WHERE sls_order_dt IS NULL) AS d FROM clean_sales_details) q",
            [('amount_overflow', 'o'), ('no_order_date', 'd')])} UNION ALL {_dq_rows('DQ9', 'values_lost', 'clean_prd_info',
            "(SELECT COUNT(*) FILTER (WHERE prd_start_dt IS NULL) AS s, COUNT(*) FILTER (WHERE prd_key = '') AS k FROM clean_prd_info) q",
            [('no_start_date', 's'), ('short_product_key', 'k')])}""",
        "dq10_values_lost_by_rule": f"{head} {_losses(p)}",
        "src1_csv_scan": """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey,
  'say "' || p_name || '", then' || chr(10) || p_brand AS p_text, p_type FROM part""",
        "dq7_segment_distribution": f"""{head}, {star}, {rc}, {rp}
SELECT 'DQ7' AS check_id, 'segment_distribution' AS check_name, 'report_customers' AS table_name,
       customer_segment AS metric, CAST(COUNT(cst_id) AS BIGINT) AS value FROM report_customers GROUP BY customer_segment
UNION ALL
SELECT 'DQ7', 'segment_distribution', 'report_products', product_segment, CAST(COUNT(prd_key) AS BIGINT)
FROM report_products GROUP BY product_segment""",
    }
