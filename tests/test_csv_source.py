"""CSV reading and the bronze layer on small files written here."""

import os

import pytest
from pyspark.sql import functions as F

from starbeam.config import DEFAULT
from starbeam.operators import cleaning, dimensions
from starbeam.plans import warehouse
from starbeam.sources.csv_source import BAD_ROW, load_sources, read_csv


@pytest.fixture
def write(tmp_path):
    def put(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return put


def test_quotes_line_breaks_commas_and_padding(spark, write):
    path = write("a.csv", 'id,name,note\n1,"Road ""X"" bikes","two\nlines, one field"\n2, padded ,n/a\n3,,"é😀"\n')
    rows = [tuple(r) for r in read_csv(spark, path).orderBy("id").collect()]
    assert rows == [("1", 'Road "X" bikes', "two\nlines, one field"), ("2", " padded ", None), ("3", None, "é😀")]


def test_short_and_long_rows_are_kept_and_counted(spark, write):
    path = write("b.csv", "id,a,b\n1,x,y\n2,x\n3,x,y,EXTRA\n4,x,y\n")
    rows = {r["id"]: r for r in read_csv(spark, path, keep_bad_rows=True).collect()}
    assert len(rows) == 4
    assert rows["2"]["a"] == "x" and rows["2"]["b"] is None
    assert {k for k, r in rows.items() if r[BAD_ROW]} == {"2", "3"} and "EXTRA" in rows["3"][BAD_ROW]


PRODUCTS = """prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt
1,AA-BB-X-1,Frame,10.75,R ,2011-07-01,2012-06-30
2,AA-BB-X-1,Frame,11.25,R ,07/01/2012,
3,AA-CC-Y-2,Wheel,,M,2012-07-01,
4,ZZ-QQ-W-3,Odd,bad,,2011-01-05,
"""
CATEGORIES = "ID,CAT,SUBCAT,MAINTENANCE\nAA_BB,Parts,Frames,Yes\nAA_CC, Parts ,,No\n"


def test_product_dimension_of_a_small_file(spark, write):
    """DIM6-DIM10 against rows worked out by hand."""
    prd = cleaning.clean("raw_prd_info", read_csv(spark, write("p.csv", PRODUCTS)), DEFAULT.as_of)[1]
    cat = cleaning.clean("raw_px_cat_g1v2", read_csv(spark, write("c.csv", CATEGORIES)), DEFAULT.as_of)[1]
    assert dimensions.active_products(prd).count() == 3
    rows = [tuple(str(x) if x is not None else None for x in r) for r in dimensions.dim_products(prd, cat, DEFAULT).orderBy("product_key").select(
        "product_key", "product_number", "product_name", "category", "subcategory", "cost", "product_line", "start_date").collect()]
    assert rows == [
        ("1", "W-3", "Odd", None, None, "0.0000", "n/a", "2011-01-05"),
        ("2", "X-1", "Frame", "Parts", "Frames", "11.2500", "Road", "2012-07-01"),
        ("3", "Y-2", "Wheel", "Parts", "Unknown", "0.0000", "Mountain", "2012-07-01"),
    ]


FILES = {
    "source_crm/cust_info.csv": "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\n"
    "9007199254740993,K1,Ann,Lee,S,F,2024-01-01\n9007199254740992,K2,Bob,Ray,M,M,2024-01-01\n",
    "source_crm/prd_info.csv": PRODUCTS,
    "source_crm/sales_details.csv": "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,sls_price\n"
    "S1,X-1,9007199254740993,20130105.0,20130106,20130107,5,2.5,2.345\nS2,Y-2,9007199254740992,20130205,20130206,20130207,7,1,7\n"
    "S3,Y-2,9007199254740992,20130305,20130306,20130307,7,99999999999999,99999\nS4,nope,1,0,x,,1,1,1\nS5,Y-2\n",
    "source_erp/CUST_AZ12.csv": "CID,BDATE,GEN\nNAS9007199254740993,12/05/1980,F\n9007199254740992,1970-01-01,M\n",
    "source_erp/LOC_A101.csv": "CID,CNTRY\n9007199254740993,DE\n9007199254740992, US\n",
    "source_erp/PX_CAT_G1V2.csv": CATEGORIES,
}


def _load(spark, write, files):
    for name, text in files.items():
        path = write(name, text)
    return load_sources(spark, path[: path.index("source_erp")])


def test_values_survive_to_gold(spark, write, tmp_path):
    res = warehouse.run(spark, _load(spark, write, FILES).tables, str(tmp_path / "wh"), DEFAULT, with_reports=True)
    assert res.ok, res.errors
    fact = {r["sls_ord_num"]: r for r in res.tables["gold.fact_sales"].collect()}
    assert set(fact) == {"S1", "S2", "S3", "S4"}
    assert str(fact["S1"]["sls_quantity"]) == "2.5000" and str(fact["S1"]["sales_amount"]) == "5.8625"
    assert str(fact["S1"]["profit"]) == "-22.2625" and str(fact["S1"]["sls_order_dt"]) == "2013-01-05"
    assert fact["S3"]["sales_amount"] is None and fact["S4"]["sls_order_dt"] is None
    born = {r["cst_id"]: str(r["bdate"]) for r in res.tables["gold.dim_customers"].collect()}
    assert born == {9007199254740993: "1980-12-05", 9007199254740992: "1970-01-01"}
    assert res.bad_rows["raw_sales_details"] == 1
    dq = {(r["check_id"], r["table_name"], r["metric"]): r["value"] for r in res.tables["quality.dq_results"].collect()}
    assert dq[("DQ8", "raw_sales_details", "rows")] == 1 and dq[("DQ9", "clean_sales_details", "amount_overflow")] == 1
    assert dq[("DQ4", "fact_sales", "orphan_product_rows")] == 1


def test_other_column_names_give_the_same_gold(spark, write, tmp_path):
    renamed = dict(FILES)
    renamed["source_crm/sales_details.csv"] = FILES["source_crm/sales_details.csv"].replace(
        "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt", "order_number,product_key,Customer_Id,when_ordered", 1)
    renamed["source_erp/CUST_AZ12.csv"] = FILES["source_erp/CUST_AZ12.csv"].replace("BDATE", "birth_date")
    params = DEFAULT.__class__(role_overrides={"sales_order_date": "when_ordered"})
    a = warehouse.run(spark, _load(spark, write, FILES).tables, str(tmp_path / "a"), DEFAULT)
    b = warehouse.run(spark, _load(spark, write, renamed).tables, str(tmp_path / "b"), params)
    assert a.ok and b.ok, (a.errors, b.errors)
    for t in ("gold.fact_sales", "gold.dim_customers"):
        assert sorted(map(str, a.tables[t].collect())) == sorted(map(str, b.tables[t].select(a.tables[t].columns).collect()))


def test_missing_and_unreadable_sources_do_not_stop_the_others(spark, write, tmp_path):
    files = {k: v for k, v in FILES.items() if "LOC" not in k}
    load = _load(spark, write, files)
    assert set(load.missing) == {"raw_loc_a101"} and len(load.tables) == 5
    broken = spark.range(1).select(F.raise_error(F.lit("cannot be read")).cast("string").alias("cid"))
    res = warehouse.run(spark, {"raw_cust_az12": broken, **{k: v for k, v in load.tables.items() if k != "raw_cust_az12"}},
                        str(tmp_path / "wh"), DEFAULT, missing_sources=load.missing)
    assert not res.ok and res.failed_layer == "bronze"
    assert len([a for a in res.audit if a[0] == "bronze" and a[7] is None]) == 4
    assert os.path.isdir(tmp_path / "wh" / "bronze" / "raw_sales_details")
