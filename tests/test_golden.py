"""Golden checks against the two published outputs of the source system."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from starbeam.config import DEFAULT
from starbeam.functions import binning
from starbeam.functions.numeric import half_even, ratio_or
from starbeam.operators import cleaning, dimensions
from starbeam.sources.csv_source import read_csv


def _clean_inputs(spark, root):
    prd = read_csv(spark, os.path.join(root, "source_crm/prd_info.csv"))
    cat = read_csv(spark, os.path.join(root, "source_erp/PX_CAT_G1V2.csv"))
    return cleaning.clean_prd_info(prd), cleaning.clean_px_cat_g1v2(cat)


def test_bronze_keeps_padding_and_nulls_markers(spark, reference_data):
    prd = read_csv(spark, os.path.join(reference_data, "source_crm/prd_info.csv"))
    assert prd.count() == 397
    lines = {r[0] for r in prd.select("prd_line").distinct().collect()}
    assert "R " in lines and None in lines
    assert prd.where(F.col("prd_cost").isNull()).count() == 2


def test_product_dimension_equals_published_file(spark, reference_data):
    prd, cat = _clean_inputs(spark, reference_data)
    got = dimensions.dim_products(prd, cat, DEFAULT).toPandas()
    want = pd.read_csv(os.path.join(reference_data, "analytics_ready/gold.dim_products.csv"),
                       keep_default_na=False, na_values=[""])
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want) == 295
    got = got.sort_values("product_key").reset_index(drop=True)
    want = want.sort_values("product_key").reset_index(drop=True)
    got["start_date"] = got["start_date"].astype(str)
    for c in want.columns:
        g = got[c].where(got[c].notna(), None).tolist()
        w = want[c].where(want[c].notna(), None).tolist()
        assert g == w, c


def test_category_counts_of_product_dimension(spark, reference_data):
    prd, cat = _clean_inputs(spark, reference_data)
    dim = dimensions.dim_products(prd, cat, DEFAULT)
    counts = {r["category"]: r["n"] for r in dim.groupBy("category").agg(F.count("*").alias("n")).collect()}
    assert counts == {"Components": 127, "Bikes": 97, "Clothing": 35, "Accessories": 29, None: 7}


def test_active_filter_keeps_open_versions(spark, reference_data):
    prd, _ = _clean_inputs(spark, reference_data)
    assert dimensions.active_products(prd).count() == 197


def test_cost_ranges_of_published_dimension(spark, reference_data):
    dim = spark.read.option("header", "true").option("inferSchema", "true").csv(
        os.path.join(reference_data, "analytics_ready/gold.dim_products.csv"))
    ranges = dim.select(binning.cost_range("cost", DEFAULT.cost_bounds).alias("r")).groupBy("r").count()
    got = {r["r"]: r["count"] for r in ranges.collect()}
    assert got == {"Below 100": 110, "100-500": 101, "500-1000": 45, "Above 1000": 39}


def test_report_rules_on_published_report(spark, reference_data):
    rep = spark.read.option("header", "true").option("inferSchema", "true").csv(
        os.path.join(reference_data, "reporting_ready/gold.report_products.csv"))
    checked = rep.select(
        "product_segment", "avg_selling_price", "total_sales",
        binning.product_segment("total_sales", DEFAULT).alias("seg"),
        half_even(ratio_or(F.col("total_sales").cast("decimal(18,2)"), "total_quantity", F.lit(0)), 1)
        .cast("double").alias("asp"),
    )
    assert checked.where(F.col("seg") != F.col("product_segment")).count() == 0
    assert checked.where(F.abs(F.col("asp") - F.col("avg_selling_price")) > 1e-9).count() == 0
    seg = {r[0]: r[1] for r in rep.groupBy("product_segment").count().collect()}
    assert seg == {"High-Performer": 66, "Mid-Range": 58, "Low-Performer": 6}
    assert rep.agg(F.sum("total_sales")).first()[0] == 29351258


@pytest.mark.parametrize("name", ["prd_info", "px_cat"])
def test_header_normalise_and_dedup_are_idempotent(spark, reference_data, name):
    rel = "source_crm/prd_info.csv" if name == "prd_info" else "source_erp/PX_CAT_G1V2.csv"
    raw = read_csv(spark, os.path.join(reference_data, rel))
    once = cleaning.drop_exact_duplicates(cleaning.normalise_headers(raw))
    twice = cleaning.drop_exact_duplicates(cleaning.normalise_headers(once))
    assert once.columns == [c.lower().strip() for c in raw.columns]
    assert once.count() == twice.count()
