"""Layered batch run: bronze -> silver -> gold [-> reports] -> quality [-> analytics] (SNK1-SNK3).

One Spark application; every layer reads the previous layer's written tables, so
each layer's plan starts from parquet files (lineage is cut at every layer, and a
lost executor only recomputes within the current layer). Tables are replaced as a
whole: a failed write leaves the old one (``table_store``). The run stops at the first failing layer; every table write adds an
audit row (layer, table, rows, columns, seconds). Every stored table keeps the fingerprint of what it was made from
(``fingerprints``); a run with ``restart`` takes a table whose fingerprint has not changed as it is and makes the others.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbeam.config import Params
from starbeam.functions.numeric import PRICE
from starbeam.operators import cleaning, date_order, dimensions, quality, reports
from starbeam.operators.collation import collated_star
from starbeam.plans import analytics, fingerprints
from starbeam.plans.star import Star
from starbeam.plans.table_store import current, read_table, replace_table
from starbeam.sources.csv_source import BAD_ROW

FACT_PARTITION = "order_year"
# Unit cost columns that sales lines may carry.
LINE_COSTS = ("unit_cost", "sls_cost", "cost")
AUDIT_SCHEMA = ("layer string, table_name string, rows_in bigint, rows_written bigint, rows_removed bigint, "
                "columns int, seconds double, error string, reused boolean")


@dataclass
class RunResult:
    ok: bool = True
    failed_layer: str | None = None
    error: str | None = None
    errors: list[str] = field(default_factory=list)
    audit: list[tuple] = field(default_factory=list)
    layer_seconds: dict[str, float] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    observed: dict[str, dict] = field(default_factory=dict)
    bad_rows: dict[str, int] = field(default_factory=dict)
    losses: dict[str, dict] = field(default_factory=dict)
    date_votes: dict[str, list[dict]] = field(default_factory=dict)

    def fail(self, layer: str, name: str, e: Exception) -> None:
        self.ok, self.failed_layer = False, self.failed_layer or layer
        self.errors.append(f"{name}: {type(e).__name__}: {e}")
        self.error = self.error or self.errors[0]
        self.audit.append((layer, name, None, None, None, None, None, self.errors[-1][:2000], False))

    def rows(self, layer: str, name: str) -> int | None:
        """Rows written to a table of this run."""
        return next((a[3] for a in self.audit if a[:2] == (layer, name)), None)

    def reused(self) -> list[str]:
        """The tables of this run that were taken as they stood."""
        return [f"{a[0]}.{a[1]}" for a in self.audit if a[8]]

    def audit_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.audit, AUDIT_SCHEMA)


class Warehouse:
    """Writes and reads the layer tables under ``root`` (a shared folder on a cluster)."""

    def __init__(self, spark: SparkSession, root: str, params: Params, restart: bool = False):
        self.spark, self.root, self.p, self.restart = spark, root, params, restart
        self.result = RunResult()
        self.marks: dict[str, str | None] = {}

    def path(self, layer: str, name: str) -> str:
        return os.path.join(self.root, layer, name)

    def write(self, layer: str, name: str, table: DataFrame | Callable[[], DataFrame], partition_by: str | None = None,
              source: tuple[str, str] | None = None, reads: Sequence[str] | None = None, given=None,
              note: Callable[[], dict] | None = None) -> DataFrame:
        """SNK1 + SNK2: replace the table as a whole, then read it back and count it. ``source`` is the
        table whose rows it cleans: the audit shows its rows and how many were removed. ``reads`` names the stored
        tables that it is made from and ``given`` what else decides its rows; with both, its fingerprint is kept, and a
        restarted run leaves an unchanged table alone (``table`` is then not called). ``note`` is kept with it."""
        t0, path = time.time(), self.path(layer, name)
        mark = None
        if reads is not None:
            mark = fingerprints.digest(fingerprints.code(), layer, name, partition_by or "", repr(given), *[self.marks.get(r) for r in reads])
        reused = self.restart and mark is not None and current(self.spark, path)[1].get("mark") == mark
        if reused:
            stored = read_table(self.spark, path)
        else:
            df = table() if callable(table) else table
            stored = replace_table(self.spark, path, df, partition_by, lambda: {"mark": mark, **(note() if note else {})})
        self.marks[f"{layer}.{name}"] = mark
        rows = stored.count()  # parquet footers: no data scan
        rows_in = self.result.rows(*source) if source else None
        removed = rows_in - rows if rows_in is not None else None
        self.result.audit.append((layer, name, rows_in, rows, removed, len(stored.columns), round(time.time() - t0, 3), None, reused))
        self.result.tables[f"{layer}.{name}"] = stored
        return stored

    # ------------------------------------------------------------ layers

    def bronze(self, raw: dict[str, DataFrame], files: dict[str, str] | None = None) -> dict[str, DataFrame]:
        """Every source is loaded; one that cannot be read fails the layer after the others. ``files`` has the
        paths of sources that are plain files: these tell whether a source has changed."""
        out = {}
        for name, df in raw.items():
            try:
                path = (files or {}).get(name)
                made_from = fingerprints.files(self.spark, [path]) if path else fingerprints.frame(df)
                out[name] = self.write("bronze", name, df, reads=() if made_from else None, given=made_from)
                if BAD_ROW in out[name].columns:
                    self.result.bad_rows[name] = out[name].where(F.col(BAD_ROW).isNotNull()).count()
            except Exception as e:
                self.result.fail("bronze", name, e)
        if self.result.errors:
            raise RuntimeError(self.result.errors[0])
        return out

    def date_forms(self, name: str, df: DataFrame) -> list[dict]:
        """CLN8: the votes of the table's free-form date columns, one row a column (``date_order`` other than vote: none)."""
        frame = cleaning.canonical(name, df, self.p.role_overrides)
        columns = cleaning.date_columns(name, frame.columns)
        if self.p.date_order != "vote" or not columns:
            return [{"column_name": c, "date_form": self.p.date_order, **dict.fromkeys(("day_first", "month_first", "either", "ambiguous"), 0)} for c in columns]
        return [r.asDict() for r in date_order.vote(frame, columns).collect()]

    def silver(self, bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
        out = {}
        given = (self.p.as_of, self.p.role_overrides, self.p.date_order)
        for name, df in bronze.items():
            target, make, note = self._cleaned(name, df)
            out[target] = self.write("silver", target, make, source=("bronze", name), reads=[f"bronze.{name}"], given=given, note=note)
            kept = current(self.spark, self.path("silver", target))[1]
            for field_, store, key in (("losses", self.result.losses, name), ("observed", self.result.observed, "sales"), ("votes", self.result.date_votes, name)):
                if kept.get(field_):
                    store[key] = kept[field_]
        return out

    def _cleaned(self, name: str, df: DataFrame):
        """(silver name, maker of the cleaned table, maker of its note): the counts for the quality checks are observed during
        the write itself and kept with the table, so a restarted run still has them."""
        from pyspark.sql import Observation

        losses = Observation(f"losses_{name}") if name in cleaning.READS else None
        options = {"observation": Observation("sales_cleaning")} if name == "raw_sales_details" else {}
        votes: list[dict] = []

        def make() -> DataFrame:
            votes.extend(self.date_forms(name, df))
            forms = {v["column_name"]: v["date_form"] for v in votes}
            return cleaning.clean(name, df, self.p.as_of, self.p.role_overrides, losses=losses, forms=forms, **options)[1]

        def note() -> dict:
            observed = dict(options["observation"].get) if options else {}
            return {"losses": dict(losses.get) if losses is not None else {}, "observed": observed, "votes": votes}

        return cleaning.CLEANERS[name][0], make, note

    def gold(self, silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
        p = self.p
        crm, demographics, locations = (silver[n] for n in ("clean_cust_info", "clean_cust_az12", "clean_loc_a101"))

        def customers() -> DataFrame:
            dimensions.check_join_key(dimensions.join_key_rates(crm, demographics), p)
            return dimensions.dim_customers(crm, demographics, locations, p)

        dim_c = self.write("gold", "dim_customers", customers, given=p,
                           reads=["silver.clean_cust_info", "silver.clean_cust_az12", "silver.clean_loc_a101"])
        dim_p = self.write("gold", "dim_products",
                           lambda: dimensions.dim_products(silver["clean_prd_info"], silver["clean_px_cat_g1v2"], p), given=p,
                           reads=["silver.clean_prd_info", "silver.clean_px_cat_g1v2"])

        def sales() -> DataFrame:
            fact = dimensions.add_profit(fact_from_silver(silver["clean_sales_details"]), star_products_view(dim_p), p)
            # REBALANCE lets AQE cut each year into evenly sized write tasks (no task per
            # year, no file per input task and year)
            return fact.withColumn(FACT_PARTITION, F.year("sls_order_dt")).hint("rebalance", FACT_PARTITION)

        fact = self.write("gold", "fact_sales", sales, partition_by=FACT_PARTITION, given=p,
                          reads=["silver.clean_sales_details", "gold.dim_products"])
        dim_d = self.write("gold", "dim_date", lambda: dimensions.dim_date(fact), given=p, reads=["gold.fact_sales"])
        return {"dim_customers": dim_c, "dim_products": dim_p, "fact_sales": fact, "dim_date": dim_d}

    def reports(self, gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
        star = star_from_gold(gold, self.p.collation)
        reads = [f"gold.{name}" for name in gold]
        rc = self.write("gold", "report_customers", lambda: reports.report_customers(star, self.p), given=self.p, reads=reads)
        rp = self.write("gold", "report_products", lambda: reports.report_products(star, self.p), given=self.p, reads=reads)
        if not self.result.rows("gold", "report_products"):
            raise ValueError("report_products: no sale matches a product key")
        return {"report_customers": rc, "report_products": rp}

    def analytics(self, gold: dict[str, DataFrame], reps: dict[str, DataFrame]) -> dict[str, DataFrame]:
        star = star_from_gold(gold, self.p.collation)
        reads = [f"gold.{name}" for name in (*gold, *reps)]
        more = {"q27_customers_by_segment": {"report": reps["report_customers"]}, "q01_gold_tables": {"reports": reps}}
        out = {}
        for name, fn in analytics.QUERIES.items():
            try:
                out[name] = self.write("analytics", name, lambda: fn(star, self.p, **more.get(name, {})), given=self.p, reads=reads)  # noqa: B023
            except Exception as e:  # the other queries are still written; the run is reported as failed
                self.result.fail("analytics", name, e)
        return out


def fact_from_silver(sales: DataFrame) -> DataFrame:
    """DIM13: the fact's columns from the cleaned sales lines."""
    columns = ["sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt",
               "sls_due_dt", "sls_quantity", "sls_price", "sls_sales", "sales_amount"]
    columns += [c for c in LINE_COSTS if c in sales.columns]
    optional = {"sls_ship_dt": "date", "sls_due_dt": "date", "sls_sales": PRICE}
    return sales.select(*[F.lit(None).cast(optional[c]).alias(c) if c in optional and c not in sales.columns else c
                          for c in columns])


def star_products_view(dim_products: DataFrame) -> DataFrame:
    """The product dimension under the names the queries use."""
    return dim_products.select(
        F.col("product_number").alias("prd_key"), F.col("product_name").alias("prd_nm"),
        F.col("category").alias("cat"), F.col("subcategory").alias("subcat"),
        F.col("cost").alias("prd_cost"))


def star_from_gold(gold: dict[str, DataFrame], collation: str | None = None) -> Star:
    customers = gold["dim_customers"].select("cst_id", "cst_key", "cst_firstname", "cst_lastname",
                                             "cst_gndr", "cntry", "bdate")
    star = Star(fact=gold["fact_sales"], customers=customers,
                products=star_products_view(gold["dim_products"]), dates=gold.get("dim_date"))
    return collated_star(star, collation) if collation else star


def run(spark: SparkSession, raw: dict[str, DataFrame], root: str, p: Params,
        with_reports: bool = False, with_analytics: bool = False, full: bool = False,
        missing_sources: dict | None = None, restart: bool = False,
        source_files: dict[str, str] | None = None) -> RunResult:
    """SNK3: run the layers in order and stop at the first failure.

    ``with_analytics`` implies reports; ``full`` runs everything. Missing sources
    (SRC3) fail the bronze layer after the present ones are loaded. With ``restart``
    tables made from the same inputs, parameters and code are taken as they stand, so a
    failed run goes on where it stopped; ``source_files`` has the paths of raw tables that are
    files.
    """
    wh = Warehouse(spark, root, p, restart)
    res = wh.result
    run_reports = with_reports or with_analytics or full
    run_analytics = with_analytics or full
    steps = [("bronze", lambda st: wh.bronze(raw, source_files)),
             ("silver", lambda st: wh.silver(st["bronze"])),
             ("gold", lambda st: wh.gold(st["silver"]))]
    if run_reports:
        steps.append(("reports", lambda st: wh.reports(st["gold"])))
    steps.append(("quality", lambda st: {"dq_results": wh.write("quality", "dq_results", lambda: dq_results(
        spark, st["bronze"], st["gold"], st.get("reports"), p, silver=st["silver"],
        observed=res.observed, bad_rows=res.bad_rows, losses=res.losses, date_votes=res.date_votes), given=(p, sorted(st)),
        reads=sorted(wh.marks))}))
    if run_analytics:
        steps.append(("analytics", lambda st: wh.analytics(st["gold"], st["reports"])))
    state: dict[str, dict] = {}
    for layer, step in steps:
        t0 = time.time()
        try:
            state[layer] = step(state)
            if layer == "bronze" and missing_sources:
                raise FileNotFoundError(f"missing sources: {sorted(missing_sources)}")
        except Exception as e:  # stop at the first failing layer
            res.ok, res.failed_layer, res.error = False, layer, f"{type(e).__name__}: {e}"
            res.errors = res.errors or [res.error]
            res.layer_seconds[layer] = round(time.time() - t0, 3)
            break
        res.layer_seconds[layer] = round(time.time() - t0, 3)
    if res.audit:
        replace_table(spark, wh.path("quality", "audit"), res.audit_frame(spark))
    return res


def register_views(star: Star, reports: dict[str, DataFrame] | None = None,
                   extra: dict[str, DataFrame] | None = None) -> list[str]:
    """SRC5: expose the star under the source system's table names, so analytic SQL
    text runs unchanged through ``spark.sql`` (temporary views, this session only).

    ``dim_products`` carries the query column names (prd_key, prd_nm, cat, subcat,
    prd_cost); the date dimension is derived from the fact when not given.
    """
    views = {"fact_sales": star.fact, "dim_customers": star.customers, "dim_products": star.products,
             "dim_date": star.dates if star.dates is not None else dimensions.dim_date(star.fact)}
    views.update(reports or {})
    views.update(extra or {})
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


def publish_extracts(res: RunResult, out_dir: str) -> dict[str, str]:
    """SNK4: CSV extracts (header row) of the product dimension and product report.

    Written as a folder of part files by the executors; nothing passes through the
    driver, whatever the table size.
    """
    paths = {}
    for key, name in (("gold.dim_products", "gold.dim_products"), ("gold.report_products", "gold.report_products")):
        if key in res.tables:
            path = os.path.join(out_dir, name)
            table = res.tables[key]
            if "cost" in table.columns:  # published without the fraction where there is none
                whole = F.col("cost") == F.floor("cost")
                table = table.withColumn("cost", F.when(whole, F.col("cost").cast("bigint").cast("string"))
                                         .otherwise(F.col("cost").cast("string")))
            table.write.mode("overwrite").option("header", "true").csv(path)
            paths[name] = path
    return paths


# Cleaners that remove no rows besides exact duplicates (the sales cleaner also
# drops rows with a missing key).
DEDUP_ONLY = ("raw_cust_info", "raw_prd_info", "raw_cust_az12", "raw_loc_a101", "raw_px_cat_g1v2")


def dq_results(spark: SparkSession, raw: dict[str, DataFrame], gold: dict[str, DataFrame],
               reps: dict[str, DataFrame] | None, p: Params,
               silver: dict[str, DataFrame] | None = None, observed: dict | None = None,
               bad_rows: dict[str, int] | None = None, losses: dict[str, dict] | None = None,
               date_votes: dict[str, list[dict]] | None = None) -> DataFrame:
    """All data-quality checks of a run as one DataFrame.

    With the written ``silver`` tables, DQ1 of the de-duplicate-only tables comes
    from stored row counts instead of a second de-duplication of the raw input;
    with the counts ``observed`` while the sales were cleaned, DQ1 and DQ2 of the
    sales need no pass of their own either.
    """
    star = star_from_gold(gold)
    sales = (observed or {}).get("sales")
    parts = []
    for name, df in raw.items():
        target = cleaning.CLEANERS[name][0]
        if silver is not None and name in DEDUP_ONLY and target in silver:
            parts.append(quality.duplicates_removed_from_counts(spark, name, df.count(), silver[target].count()))
        elif name == "raw_sales_details" and sales is not None:
            parts.append(quality.duplicates_removed_from_counts(spark, name, df.count(), sales["rows_deduped"]))
        else:
            parts.append(quality.duplicates_removed(df, name))
    if sales is not None:
        parts.append(quality.null_key_rows_from_counts(spark, sales["rows_deduped"], sales["rows_null_key"]))
    else:
        parts.append(quality.null_key_rows(cleaning.canonical("raw_sales_details", raw["raw_sales_details"], p.role_overrides)))
    parts += [quality.future_dates(cleaning.canonical("raw_cust_az12", raw["raw_cust_az12"], p.role_overrides), p.as_of),
              quality.orphans(star.fact, star.customers, star.products),
              quality.match_rate(gold["dim_customers"]),
              quality.nonempty_join(star.fact, star.products)]
    parts += [quality.malformed_rows(spark, name, n) for name, n in (bad_rows or {}).items()]
    if silver is not None:
        parts.append(quality.values_lost(silver["clean_sales_details"], silver["clean_prd_info"]))
    if losses:
        parts.append(quality.observed_losses(spark, losses))
    if date_votes:
        parts.append(quality.date_orders(spark, date_votes))
    if reps:
        parts.append(quality.segment_distribution(reps["report_customers"], "customer_segment", "cst_id",
                                                  "report_customers"))
        parts.append(quality.segment_distribution(reps["report_products"], "product_segment", "prd_key",
                                                  "report_products"))
    return quality.union_all(parts)
