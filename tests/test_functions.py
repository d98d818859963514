"""Edge cases of the column helpers and cleaning rules (small literal frames)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starbeam import config
from starbeam.config import DEFAULT, Params
from starbeam.functions import binning, dates, numeric, text
from starbeam.operators import cleaning
from starbeam.sources.csv_source import na_tokens_to_null


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("raw,want", [
    (" m", "Male"), ("F ", "Female"), ("female", "Female"), ("MALE", "Male"),
    ("N/A", None), ("nas", None), ("x", "X"), (None, None), ("\tm\n", "Male"),
])
def test_gender_recode(spark, raw, want):
    assert one(spark, text.recode("v", config.GENDER_CODES, config.GENDER_NULL_CODES), raw) == want


@pytest.mark.parametrize("raw,want", [(" s", "Single"), ("m ", "Married"), ("married", "Married"), ("w", "W")])
def test_marital_recode(spark, raw, want):
    assert one(spark, text.recode("v", config.MARITAL_CODES), raw) == want


@pytest.mark.parametrize("raw,want", [("11000.0", 11000), ("42", 42), ("4.5", None), ("abc", None), (None, None)])
def test_try_integer(spark, raw, want):
    assert one(spark, numeric.try_integer("v"), raw) == want


@pytest.mark.parametrize("raw,want", [
    ("20101229", dt.date(2010, 12, 29)), ("0", None), ("20101301", None), ("2010122", None),
    ("20110229", None), (None, None),
])
def test_compact_dates(spark, raw, want):
    assert one(spark, dates.parse_yyyymmdd("v"), raw) == want


def test_compact_dates_from_integer(spark):
    assert one(spark, dates.parse_yyyymmdd("v"), 20120315, "v bigint") == dt.date(2012, 3, 15)


@pytest.mark.parametrize("a,b,full,calendar", [
    (dt.date(2020, 1, 31), dt.date(2020, 2, 29), 0, 1),
    (dt.date(2020, 1, 1), dt.date(2020, 2, 1), 1, 1),
    (dt.date(2019, 12, 31), dt.date(2020, 1, 1), 0, 1),
    (dt.date(2020, 5, 5), dt.date(2020, 5, 30), 0, 0),
])
def test_month_differences(spark, a, b, full, calendar):
    df = spark.createDataFrame([(a, b)], "a date, b date")
    row = df.select(dates.full_months("a", "b").alias("f"), dates.calendar_months("b", "a").alias("c")).first()
    assert (row["f"], row["c"]) == (full, calendar)


def test_lifespan_is_clipped_recency_is_not(spark):
    df = spark.createDataFrame([(dt.date(2020, 5, 1), dt.date(2020, 3, 1))], "a date, b date")
    row = df.select(dates.calendar_months_clipped("b", "a").alias("l"), dates.calendar_months("b", "a").alias("r")).first()
    assert (row["l"], row["r"]) == (0, -2)


def test_full_years_leap_day(spark):
    df = spark.createDataFrame([(dt.date(1960, 2, 29),)], "b date")
    assert df.select(dates.full_years("b", dt.date(2025, 2, 28)).alias("y")).first()["y"] == 64


def test_age_rounding_and_bins(spark):
    as_of = dt.date(2025, 1, 31)
    # 19.6 years rounds to 20 -> '20-29' (bins are right-closed)
    bdate = as_of - dt.timedelta(days=int(19.6 * 365.25))
    df = spark.createDataFrame([(bdate,), (None,), (as_of + dt.timedelta(days=30),)], "b date")
    rows = df.select(dates.age_years("b", as_of).alias("age")).select(
        "age", binning.age_group("age").alias("g")).collect()
    assert [(r["age"], r["g"]) for r in rows] == [(20, "20-29"), (None, "Unknown"), (0, "Unknown")]


@pytest.mark.parametrize("age,label", [(19, "Under 20"), (29, "20-29"), (30, "30-39"), (49, "40-49"),
                                       (50, "50 and above"), (0, "Unknown"), (-3, "Unknown")])
def test_age_bin_edges(spark, age, label):
    assert one(spark, binning.age_group("v"), age, "v int") == label


@pytest.mark.parametrize("cost,label", [(99, "Below 100"), (100, "100-500"), (500, "100-500"),
                                        (501, "500-1000"), (1000, "500-1000"), (1001, "Above 1000"),
                                        (None, "Above 1000")])
def test_cost_range_overlap_and_null(spark, cost, label):
    assert one(spark, binning.cost_range("v", DEFAULT.cost_bounds), cost, "v int") == label


@pytest.mark.parametrize("lifespan,sales,seg", [(12, 5001.0, "VIP"), (12, 5000.0, "Regular"), (11, 1e9, "New"),
                                                (None, 1e9, "New")])
def test_customer_segment(spark, lifespan, sales, seg):
    df = spark.createDataFrame([(lifespan, sales)], "l int, s double")
    assert df.select(binning.customer_segment("l", "s", DEFAULT).alias("r")).first()["r"] == seg


@pytest.mark.parametrize("sales,seg", [(50001.0, "High-Performer"), (50000.0, "Mid-Range"),
                                       (10000.0, "Mid-Range"), (9999.0, "Low-Performer")])
def test_product_segment(spark, sales, seg):
    assert one(spark, binning.product_segment("v", DEFAULT), sales, "v double") == seg


def test_banker_rounding_in_reports(spark):
    df = spark.createDataFrame([("100.01", 2), ("100.03", 2), ("5.00", 0)], "s string, n int")
    ratio = numeric.ratio_or(F.col("s").cast("decimal(18,2)"), "n", F.lit(0))
    out = df.select(numeric.half_even(ratio, 2).alias("r")).collect()
    assert [float(r["r"]) for r in out] == [50.0, 50.02, 0.0]


def test_na_tokens_and_country(spark):
    df = spark.createDataFrame([("n/a",), ("NULL",), (" DE",), ("USA",), ("  ",), ("Narnia",)], "cntry string")
    out = cleaning.standardise_country(na_tokens_to_null(df)).collect()
    assert [r["cntry"] for r in out] == ["Unknown", "Unknown", "Germany", "United States", "Unknown", "Narnia"]


def test_split_compound_key(spark):
    df = spark.createDataFrame([("CO-RF-FR-R92B-58",), ("AC-HE-HL-U509-R",), ("BI-MB-BK",), (None,)], "prd_key string")
    out = cleaning.split_compound_product_key(df).collect()
    assert [(r["cat_id"], r["prd_key"]) for r in out] == [
        ("CO_RF", "FR-R92B-58"), ("AC_HE", "HL-U509-R"), ("BI_MB", "BK"), (None, None)]


def test_sales_cleaning_drops_null_keys_and_fills_zero(spark):
    raw = spark.createDataFrame([
        ("SO1", "P-1", "11000.0", "20110101", "20110108", "0", "10", "2", "5"),
        ("SO1", "P-1", "11000.0", "20110101", "20110108", "0", "10", "2", "5"),
        ("SO2", None, "11001", "20110102", None, None, None, "n/a", "abc"),
        ("SO3", "P-2", None, "20110103", None, None, "7", "1", "7"),
    ], "SLS_ORD_NUM string, sls_prd_key string, sls_cust_id string, sls_order_dt string, sls_ship_dt string, "
       "sls_due_dt string, sls_sales string, sls_quantity string, sls_price string")
    out = cleaning.clean_sales_details(na_tokens_to_null(raw)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["sls_cust_id"], r["sls_due_dt"], float(r["sales_amount"])) == (11000, None, 10.0)


def test_future_birthdate_nulled(spark):
    df = spark.createDataFrame([("NAS1", "2030-01-01", "m"), ("2", "1980-02-03", None)], "cid string, bdate string, gen string")
    out = cleaning.clean_cust_az12(df, dt.date(2025, 1, 31)).orderBy("cid").collect()
    assert [(r["cid"], r["bdate"], r["gen"]) for r in out] == [("2", dt.date(1980, 2, 3), None), ("NAS1", None, "Male")]


def test_schema_tolerant_rules_skip_missing_columns(spark):
    df = spark.createDataFrame([("a",)], "other string")
    assert cleaning.clean_cust_info(df).columns == ["other"]


def test_params_are_frozen():
    with pytest.raises(Exception):
        Params().vip_sales = 1  # type: ignore[misc]
