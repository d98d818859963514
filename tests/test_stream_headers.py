"""The stream reader checks headers and keeps malformed rows, as the batch reader does."""

import pytest

from starbeam.sources.schemas import RAW_SCHEMAS
from starbeam.streaming import incremental

HEADER = ",".join(RAW_SCHEMAS["raw_sales_details"].names)


def test_a_file_with_other_columns_fails_the_batch(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    swapped = HEADER.replace("sls_quantity,sls_price", "sls_price,sls_quantity")
    (landing / "a.csv").write_text(f"{swapped}\no1,p,1,20120101,20120102,20120103,10,5,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        incremental.run_available(spark, str(landing), target, str(tmp_path / "cp"))


def test_malformed_rows_are_kept_with_their_text(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    good = 'o1,"p,\n1",1,20120101,20120102,20120103,10,2,5'
    (landing / "a.csv").write_text(f"{HEADER}\n{good}\no2,p,1,20120101\no3,p,1,20120101,20120102,20120103,10,2,5,extra,more\n")
    incremental.run_available(spark, str(landing), target, str(tmp_path / "cp"))
    assert sorted(r._bad_row for r in spark.read.parquet(incremental.bad_rows_dir(target)).collect()) == [
        "o2,p,1,20120101", "o3,p,1,20120101,20120102,20120103,10,2,5,extra,more"]
    rows = {r.sls_ord_num: (r.sls_prd_key, r.sls_quantity) for r in spark.read.parquet(target).collect()}
    assert set(rows) == {"o1", "o2", "o3"} and rows["o1"] == ("p,\n1", 2)
    assert "_bad_row" not in spark.read.parquet(target).columns
