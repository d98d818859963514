"""SNK3: a restarted run takes what has not changed as it stands."""

import os
import shutil
from dataclasses import replace

import pytest

from starbeam.config import FIXTURE
from starbeam.operators import dimensions
from starbeam.plans import fingerprints, warehouse
from starbeam.plans.table_store import current, read_table
from starbeam.sources import raw_adapter


@pytest.fixture
def writes(monkeypatch):
    """Names of the tables that were written."""
    seen, plain = [], warehouse.replace_table

    def counted(spark, path, *args, **kwargs):
        stored = plain(spark, path, *args, **kwargs)
        seen.append("/".join(path.split("/")[-2:]))
        return stored

    monkeypatch.setattr(warehouse, "replace_table", counted)
    return seen


@pytest.fixture(scope="module")
def copied(tmp_path_factory, sf_small):
    """The test tables in a folder of its own, where one of them can change."""
    to = tmp_path_factory.mktemp("sf")
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        shutil.copyfile(os.path.join(sf_small, f"{name}.parquet"), to / f"{name}.parquet")
    return str(to)


def test_a_run_that_failed_in_gold_goes_on_there(spark, copied, tmp_path, writes, monkeypatch):
    raw, root = raw_adapter.raw_tables(spark, copied), str(tmp_path / "wh")

    def broken(fact):
        raise ValueError("no dates today")

    with monkeypatch.context() as m:
        m.setattr(dimensions, "dim_date", broken)
        failed = warehouse.run(spark, raw, root, FIXTURE)
    assert failed.failed_layer == "gold" and "gold/fact_sales" in writes and "gold/dim_date" not in writes
    first = list(writes)
    writes.clear()
    again = warehouse.run(spark, raw, root, FIXTURE, restart=True)
    assert again.ok, again.error
    assert sorted(writes) == ["gold/dim_date", "quality/audit", "quality/dq_results"]
    assert sorted(again.reused()) == sorted(t.replace("/", ".") for t in first if t != "quality/audit")
    # what was observed while the silver tables were written is still known
    assert again.losses == failed.losses and again.observed["sales"]["rows_deduped"] > 0 and again.date_votes

    # nothing changed: nothing is written but the audit
    writes.clear()
    assert warehouse.run(spark, raw, root, FIXTURE, restart=True).ok and writes == ["quality/audit"]
    assert read_table(spark, os.path.join(root, "quality", "audit")).where("reused").count() == 17

    # a parameter of silver and gold: bronze stands
    writes.clear()
    later = replace(FIXTURE, as_of=FIXTURE.as_of.replace(year=FIXTURE.as_of.year + 1))
    assert warehouse.run(spark, raw, root, later, restart=True).ok
    assert not [w for w in writes if w.startswith("bronze")] and len([w for w in writes if w.startswith("silver")]) == 6

    # without the option all is written anew, and comes out the same
    writes.clear()
    before = {t: read_table(spark, os.path.join(root, *t.split("."))).collect() for t in ("quality.dq_results", "gold.dim_date")}
    whole = warehouse.run(spark, raw, root, later)
    assert whole.ok and len(writes) == 18
    for t, rows in before.items():
        assert sorted(map(str, whole.tables[t].collect())) == sorted(map(str, rows)), t


def test_a_changed_file_is_seen_and_only_its_tables_are_made_anew(spark, copied, tmp_path, writes):
    root, folder = str(tmp_path / "wh"), tmp_path / "in"
    shutil.copytree(copied, folder)
    assert warehouse.run(spark, raw_adapter.raw_tables(spark, str(folder)), root, FIXTURE, restart=True).ok
    writes.clear()
    one = spark.read.parquet(f"{folder}/supplier.parquet").limit(3).toPandas()
    one.to_parquet(f"{folder}/supplier.parquet")
    assert warehouse.run(spark, raw_adapter.raw_tables(spark, str(folder)), root, FIXTURE, restart=True).ok
    assert {w for w in writes if not w.startswith("quality")} == {"bronze/raw_cust_az12", "silver/clean_cust_az12", "gold/dim_customers"}


def test_rows_of_the_session_have_no_fingerprint(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    assert fingerprints.frame(df) is None and fingerprints.digest("x", None) is None
    wh = warehouse.Warehouse(spark, str(tmp_path), FIXTURE, restart=True)
    for _ in range(2):
        wh.write("bronze", "t", df, reads=None)
    assert not wh.result.reused() and current(spark, wh.path("bronze", "t"))[1] == {"mark": None}


def test_the_plan_counts_not_only_the_files(spark, sf_small):
    part = spark.read.parquet(f"{sf_small}/part.parquet")
    marks = {fingerprints.frame(df) for df in (part, part.where("p_size > 3"), part.where("p_size > 4"), part.select("p_size"))}
    assert len(marks) == 4 and None not in marks
    assert fingerprints.frame(part.where("p_size > 3")) in marks
