"""Records found in parallel equal those of the one-task reader, wherever the files are split."""

import random

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from starbeam.sources.csv_records import csv_lines, csv_records
from starbeam.sources.csv_source import BAD_ROW, read_csv


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def made_up(seed, rows, newline="\n"):
    rng = random.Random(seed)

    def value():
        v = "".join(rng.choice(["a", "bc", ",", '"', newline, " ", "é", "x y", newline + newline, '""', "NA"]) for _ in range(rng.randint(0, 8)))
        if rng.random() < 0.3:
            v = v.replace(",", "").replace('"', "").replace("\n", "").replace("\r", "")
            return v + ('"' if v and rng.random() < 0.2 else "")  # a quote inside an unquoted field is text
        return '"' + v.replace('"', '""') + '"'

    lines = ["id,one,two"] + [f"{i},{value()},{value()}" for i in range(rows)]
    return newline.join(lines) + rng.choice(["", newline, newline * 3])


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "4096" if k == keys[0] else "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_one_task_reader(spark, tmp_path, small_splits, seed, newline):
    path = write(tmp_path / "t.csv", made_up(seed, 1500, newline))
    assert csv_lines(spark, path).select("split").distinct().count() > 4
    want = sorted(map(tuple, read_csv(spark, path, one_task=True, keep_bad_rows=True).collect()), key=str)
    got = sorted(map(tuple, read_csv(spark, path, keep_bad_rows=True).collect()), key=str)
    assert got == want and len(got) >= 1500


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}, with a comma" for i in range(3000))
    path = write(tmp_path / "t.csv", f'id,text\n1,"{long}"\n2,plain\n\n3,"a ""b""\nc"\n')
    assert sorted(map(tuple, read_csv(spark, path).collect())) == [("1", long), ("2", "plain"), ("3", 'a "b"\nc')]
    assert {r.no for r in csv_records(spark, path).collect()} == {0, 1, 2, 3}


def test_more_than_one_task_reads_a_file(spark, tmp_path, small_splits):
    path = write(tmp_path / "t.csv", made_up(5, 2000))
    assert csv_lines(spark, path).rdd.getNumPartitions() > 4
    one = spark.read.options(header="true", multiLine="true").csv(path)
    assert one.rdd.getNumPartitions() == 1


def test_several_files_and_headers(spark, tmp_path, small_splits):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8")
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(3):
        write(folder / f"{k}.csv", "﻿" * (k == 1) + f'A,b\n{k},"x\ny"\n')
    assert sorted(map(tuple, read_csv(spark, str(folder)).collect())) == [(str(k), "x\ny") for k in range(3)]
    write(folder / "3.csv", "b,A\n1,2\n")
    with pytest.raises(Exception, match="header differs"):
        read_csv(spark, str(folder)).collect()


def test_schema_is_taken_by_name(spark, tmp_path, small_splits):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8")
    schema = StructType([StructField(n, StringType()) for n in ("cid", "bdate", "gen")])
    path = write(tmp_path / "t.csv", "CID,gen,bdate\n1,M,2000-01-01\n2,F\n")
    for one_task in (True, False):
        rows = read_csv(spark, path, schema, keep_bad_rows=True, one_task=one_task).orderBy("cid").collect()
        assert [(r.cid, r.bdate, r.gen) for r in rows] == [("1", "2000-01-01", "M"), ("2", None, "F")]
        assert [r[BAD_ROW] is None for r in rows] == [True, False]
    with pytest.raises(ValueError, match="header"):
        read_csv(spark, write(tmp_path / "u.csv", "cid,gen\n1,M\n"), schema)


def test_empty_and_header_only_files(spark, tmp_path, small_splits):
    assert read_csv(spark, write(tmp_path / "h.csv", "a,b\n")).collect() == []
    path = write(tmp_path / "q.csv", 'a,b\n1,"open\nnever closed,2\n3,4\n')
    assert [r.no for r in csv_records(spark, path).orderBy("no").collect()] == [0, 1]
