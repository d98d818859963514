"""CLN8: one form per column, found by vote over the whole column."""

import datetime as dt
from dataclasses import replace

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation

from starbeam.config import DEFAULT
from starbeam.functions import dates, numeric
from starbeam.operators import cleaning, date_order
from starbeam.plans.warehouse import Warehouse


def frame(spark, *columns):
    rows = list(zip(*columns, strict=True))
    return spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(len(columns))))


def test_a_column_is_read_in_the_form_that_its_values_have(spark):
    df = frame(spark, ["31/12/2012", "03/04/2012", "2012-01-05"], ["12/31/2012", "03/04/2012", None], ["3.4.2012", "4.3.2012", " "])
    votes = {r.column_name: r for r in date_order.vote(df, df.columns).collect()}
    assert [(v.date_form, v.ambiguous) for v in votes.values()] == [("day", False), ("month", False), ("month", True)]
    assert (votes["c0"].year_first, votes["c0"].either, votes["c1"].missing, votes["c2"].missing) == (1, 1, 1, 1)
    day = dt.date
    assert [tuple(r) for r in date_order.read_by_vote(df, df.columns).collect()] == [
        (day(2012, 12, 31), day(2012, 12, 31), day(2012, 3, 4)), (day(2012, 4, 3), day(2012, 3, 4), day(2012, 4, 3)), (day(2012, 1, 5), None, None)]


def test_values_of_the_other_form_are_null_and_impossible_days_unreadable(spark):
    df = frame(spark, ["31/12/2012", "30/11/2012", "12/31/2012", "31/02/2012", "1/2-2012", "1/2/12", "2012/3/4"])
    vote = date_order.vote(df, ["c0"]).first()
    assert (vote.day_first, vote.month_first, vote.unreadable, vote.year_first, vote.date_form) == (2, 1, 3, 1, "day")
    assert [r.c0 for r in date_order.read_by_vote(df, ["c0"]).collect()] == [dt.date(2012, 12, 31), dt.date(2012, 11, 30), None, None, None, None, dt.date(2012, 3, 4)]


def test_empty_tables_and_no_columns(spark):
    df = frame(spark, ["x"]).limit(0)
    assert date_order.vote(df, ["c0"]).first().date_form == "month"
    assert date_order.read_by_vote(df, ["c0"]).schema["c0"].dataType.simpleString() == "date"
    assert date_order.read_by_vote(df, []) is df


@settings(max_examples=5, deadline=None)
@given(days=st.lists(st.dates(dt.date(1900, 1, 1), dt.date(2099, 12, 31)), min_size=1, max_size=30), sign=st.sampled_from("/.-"), form=st.sampled_from(["day", "month"]))
def test_every_date_comes_back_if_one_day_is_above_twelve(spark, days, sign, form):
    days = [*days, dt.date(2000, 1, 31)]
    order = ("%d", "%m") if form == "day" else ("%m", "%d")
    df = spark.createDataFrame([(i, d.strftime(sign.join((*order, "%Y")))) for i, d in enumerate(days)], "i int, c string")
    assert [r.c for r in date_order.read_by_vote(df, ["c"]).orderBy("i").collect()] == days


def test_the_silver_layer_reads_and_counts_by_vote(spark, tmp_path):
    raw = spark.createDataFrame([("1", "31/12/1980"), ("2", "04/03/1980"), ("3", "13/13/1980"), ("4", "01/02/2999")], "cid string, bdate string")
    wh = Warehouse(spark, str(tmp_path), DEFAULT)
    out = wh.silver({"raw_cust_az12": raw})["clean_cust_az12"]
    assert {r.cid: r.bdate for r in out.collect()} == {"1": dt.date(1980, 12, 31), "2": dt.date(1980, 3, 4), "3": None, "4": None}
    assert wh.result.losses["raw_cust_az12"] == {"CLN8_bdate_missing": 0, "CLN8_bdate_null": 1, "CLN12_bdate_future": 1}
    assert wh.result.date_votes["raw_cust_az12"][0]["date_form"] == "day"
    by_month = Warehouse(spark, str(tmp_path), replace(DEFAULT, date_order="month")).silver({"raw_cust_az12": raw})["clean_cust_az12"]
    assert {r.cid: r.bdate for r in by_month.collect()} == {"1": None, "2": dt.date(1980, 4, 3), "3": None, "4": None}


def test_without_a_vote_columns_are_read_as_before(spark):
    raw = spark.createDataFrame([("1", "12/31/1980"), ("2", "31/12/1980")], "cid string, bdate string")
    seen = Observation()
    rows = {r.cid: r.bdate for r in cleaning.clean("raw_cust_az12", raw, DEFAULT.as_of, losses=seen)[1].collect()}
    assert rows == {"1": dt.date(1980, 12, 31), "2": None} and seen.get["CLN8_bdate_null"] == 1
    assert spark.createDataFrame([("1.2.2012",)], "c string").select(dates.parse_date("c")).first()[0] is None


def test_texts_of_another_form_do_not_reach_the_parser(spark):
    """An exception a text is what made large columns slow: each pattern sees texts of its shape only, and the votes
    of a column read it once whatever the number of columns."""
    texts = ["31/02/2012", "2012/02/30", "2012/1/2", " 1.2.2012 ", "1/2/2012\n", "13/13/2012", "0/1/2012", "1/2/12", "12012/1/2", "2012/001/02", "n/k", "2012-1-2", "", None]
    df = frame(spark, texts, texts[::-1])
    plan = lambda found: found._jdf.queryExecution().optimizedPlan().toString()
    read, voted = plan(date_order.read_by_vote(df, df.columns)), plan(date_order.vote(df, df.columns))
    assert read.count("gettimestamp(") == read.count("gettimestamp(CASE WHEN RLIKE(") and voted.count("gettimestamp(") == 1
    read = [r.d for r in df.select(dates.parse_in_form("c0", "month").alias("d")).collect()]
    day = dt.date
    assert read == [None, None, day(2012, 1, 2), day(2012, 1, 2), None, None, None, None, None, day(2012, 1, 2), None, day(2012, 1, 2), None, None]
    vote = date_order.vote(df, df.columns).collect()
    assert [(v.missing, v.year_first, v.day_first, v.month_first, v.either, v.unreadable) for v in vote] == [(2, 3, 0, 0, 1, 8)] * 2


def test_compact_dates_without_such_a_day_are_null(spark):
    df = frame(spark, ["20120229", "20120230", "20121301", "20120100", "00000000", "20120131.0", "0", None])
    assert [r.d for r in df.select(dates.parse_yyyymmdd("c0").alias("d")).collect()] == [dt.date(2012, 2, 29), None, None, None, None, dt.date(2012, 1, 31), None, None]
    assert "^[0-9]{4}(0[1-9]|1[0-2])" in df.select(dates.parse_yyyymmdd("c0"))._jdf.queryExecution().optimizedPlan().toString()


def test_a_compact_date_or_key_is_matched_once(spark):
    df = frame(spark, ["20120131.00", "20120131.0.0", "20120131\n", "20120131."], ["12.0", "+7.", "1.5", "9007199254740993"])
    both = df.select(dates.parse_yyyymmdd("c0").alias("d"), numeric.try_integer("c1").alias("n"))
    assert [tuple(r) for r in both.collect()] == [(dt.date(2012, 1, 31), 12), (None, 7), (None, None), (dt.date(2012, 1, 31), 9007199254740993)]
    assert "regexp_replace" not in both._jdf.queryExecution().optimizedPlan().toString()
