"""Layered run (bronze -> silver -> gold -> reports -> analytics) end to end."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from starbeam.plans.table_store import read_table, table_path
from starbeam.config import FIXTURE
from starbeam.plans import warehouse
from starbeam.sources import raw_adapter
from starbeam.sources.csv_source import load_sources
from starbeam.streaming import incremental


@pytest.fixture(scope="module")
def run_result(spark, sf_small):
    root = tempfile.mkdtemp(prefix="starbeam-test-wh-", dir="/tmp")
    raw = raw_adapter.raw_tables(spark, sf_small)
    res = warehouse.run(spark, raw, root, FIXTURE, full=True)
    return res, raw, root


def test_full_run_succeeds_and_audits_every_table(run_result):
    res, _, _ = run_result
    assert res.ok, res.error
    assert list(res.layer_seconds) == ["bronze", "silver", "gold", "reports", "quality", "analytics"]
    written = {(a[0], a[1]) for a in res.audit}
    for t in ("dim_customers", "dim_products", "dim_date", "fact_sales", "report_customers", "report_products"):
        assert ("gold", t) in written
    assert sum(1 for a in res.audit if a[0] == "analytics") == 27
    assert ("quality", "dq_results") in written
    assert all(a[3] >= 0 and a[7] is None for a in res.audit)
    silver = [a for a in res.audit if a[0] == "silver"]
    assert len(silver) == 6 and all(a[2] - a[4] == a[3] for a in silver) and any(a[4] for a in silver)
    assert res.rows("quality", "dq_results") and not res.errors


def test_fact_is_partitioned_by_order_year(spark, run_result):
    _, _, root = run_result
    parts = [d for d in os.listdir(table_path(spark, os.path.join(root, "gold", "fact_sales"))) if d.startswith("order_year=")]
    assert len(parts) >= 5


def test_gold_fact_rows_equal_clean_sales(run_result):
    res, _, _ = run_result
    assert res.tables["gold.fact_sales"].count() == res.tables["silver.clean_sales_details"].count()


def test_dq_results_one_frame(spark, run_result):
    res, raw, _ = run_result
    gold = {k.split(".", 1)[1]: v for k, v in res.tables.items() if k.startswith("gold.")}
    reps = {k: gold.pop(k) for k in ("report_customers", "report_products")}
    dq = warehouse.dq_results(spark, raw, gold, reps, FIXTURE)
    assert dq.columns == ["check_id", "check_name", "table_name", "metric", "value"]
    ids = {r["check_id"] for r in dq.select("check_id").distinct().collect()}
    assert ids == {f"DQ{i}" for i in range(1, 8)}
    stored = {(r["check_id"], r["metric"]): r["value"] for r in res.tables["quality.dq_results"].collect()}
    assert stored[("DQ9", "no_order_date")] > 0 and stored[("DQ4", "orphan_customer_rows")] > 0
    passed = dq.where((F.col("check_id") == "DQ6") & (F.col("metric") == "passed")).first()["value"]
    assert passed == 1


def test_audit_is_stored(spark, run_result):
    res, _, root = run_result
    stored = read_table(spark, os.path.join(root, "quality", "audit"))
    assert stored.count() == len(res.audit) and "rows_removed" in stored.columns


def test_a_failing_query_fails_the_run_and_the_others_are_written(spark, sf_small, monkeypatch):
    from starbeam.plans import analytics

    def broken(star, p):
        raise ValueError("no such column")

    monkeypatch.setattr(analytics, "QUERIES", {**{k: analytics.QUERIES[k] for k in ("q03_distinct_countries", "q10_products_by_category")}, "q99_broken": broken, "q98_broken": broken})
    root = tempfile.mkdtemp(prefix="starbeam-test-fail-", dir="/tmp")
    res = warehouse.run(spark, raw_adapter.raw_tables(spark, sf_small), root, FIXTURE, full=True)
    assert not res.ok and res.failed_layer == "analytics" and len(res.errors) == 2
    assert {"analytics.q03_distinct_countries", "analytics.q10_products_by_category"} <= set(res.tables)
    stored = read_table(spark, os.path.join(root, "quality", "audit"))
    assert stored.where("error IS NOT NULL").count() == 2


def test_incremental_sales_append_matches_batch_cleaning(spark, sf_small):
    root = tempfile.mkdtemp(prefix="starbeam-test-inc-", dir="/tmp")
    raw = raw_adapter.raw_sales_details(spark, sf_small)
    landing = os.path.join(root, "landing")
    # two arrivals; the second repeats some rows of the first
    half = (F.crc32(F.coalesce(F.col("sls_ord_num"), F.lit(""))) % 3)
    target, checkpoint = os.path.join(root, "silver_sales"), os.path.join(root, "checkpoint")
    for arrival in ((0, 1), (1, 2)):
        raw.where(half.isin(*arrival)).write.mode("append").option("header", "true").option("escape", '"').csv(landing)
        incremental.run_available(spark, landing, target, checkpoint)
    got = spark.read.parquet(target).drop("batch_id", incremental.ROW_HASH)
    from starbeam.operators import cleaning

    want = cleaning.clean_sales_details(raw)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(got.columns)).count() == 0


def test_command_line_run_with_extracts(sf_small, spark, capsys):
    from starbeam.__main__ import main

    root = tempfile.mkdtemp(prefix="starbeam-test-cli-", dir="/tmp")
    code = main(["--source", "testdata", "--sf-dir", sf_small, "--out", os.path.join(root, "wh"),
                 "--with-reports", "--extracts", os.path.join(root, "ext")])
    out = capsys.readouterr().out
    assert code == 0 and "OK" in out
    ext = spark.read.option("header", "true").csv(os.path.join(root, "ext", "gold.dim_products"))
    assert ext.count() == read_table(spark, os.path.join(root, "wh", "gold", "dim_products")).count()
    assert "product_key" in ext.columns


def test_dq1_from_counts_equals_recount(spark, run_result):
    res, _, _ = run_result
    bronze = {k.split(".", 1)[1]: v for k, v in res.tables.items() if k.startswith("bronze.")}
    silver = {k.split(".", 1)[1]: v for k, v in res.tables.items() if k.startswith("silver.")}
    gold = {k.split(".", 1)[1]: v for k, v in res.tables.items() if k.startswith("gold.")}
    for k in ("report_customers", "report_products"):
        gold.pop(k)
    fast = warehouse.dq_results(spark, bronze, gold, None, FIXTURE, silver=silver, observed=res.observed).where(
        F.col("check_id").isin("DQ1", "DQ2"))
    slow = warehouse.dq_results(spark, bronze, gold, None, FIXTURE).where(F.col("check_id").isin("DQ1", "DQ2"))
    assert res.observed["sales"]["rows_deduped"] > 0
    assert sorted(fast.collect()) == sorted(slow.collect())
    stored = res.tables["quality.dq_results"].where(F.col("check_id").isin("DQ1", "DQ2"))
    assert sorted(stored.collect()) == sorted(slow.collect())


def test_csv_sources_give_the_same_gold_as_the_adapter(spark, sf_small, run_result):
    """All six raw inputs written as CSV files in the source layout (headers as
    produced, padding kept) go through the CSV bronze reader to the same gold."""
    from starbeam.sources.schemas import RAW_FILES

    res, raw, _ = run_result
    root = tempfile.mkdtemp(prefix="starbeam-test-csv-", dir="/tmp")
    for name, rel in RAW_FILES.items():
        raw[name].write.option("header", "true").option("ignoreLeadingWhiteSpace", "false") \
            .option("ignoreTrailingWhiteSpace", "false").csv(os.path.join(root, rel))
    load = load_sources(spark, root)
    assert load.ok and set(load.tables) == set(RAW_FILES)
    res_csv = warehouse.run(spark, load.tables, os.path.join(root, "wh"), FIXTURE, with_reports=True)
    assert res_csv.ok, res_csv.error
    for t in ("gold.fact_sales", "gold.dim_customers", "gold.report_customers", "gold.report_products"):
        a, b = res.tables[t], res_csv.tables[t]
        assert a.count() == b.count(), t
        assert a.exceptAll(b.select(a.columns)).count() == 0, t
