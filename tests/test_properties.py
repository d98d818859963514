"""Property tests: column helpers against plain-Python definitions on generated data.

Each example is a batch of values evaluated in one Spark job.
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starbeam import config
from starbeam.config import DEFAULT
from starbeam.functions import binning, dates, text

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
DAYS = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31))


def completed_months(a: dt.date, b: dt.date) -> int:
    m = (b.year - a.year) * 12 + b.month - a.month
    if m > 0 and b.day < a.day:
        m -= 1
    elif m < 0 and b.day > a.day:
        m += 1
    return m


@SETTINGS
@given(st.lists(st.tuples(DAYS, DAYS), min_size=1, max_size=200))
def test_month_differences(spark, pairs):
    df = spark.createDataFrame(pairs, "a date, b date")
    got = df.select("a", "b", dates.full_months("a", "b").alias("f"), dates.calendar_months("b", "a").alias("c"),
                    dates.calendar_months_clipped("b", "a").alias("l")).collect()
    for r in got:
        cal = (r["b"].year - r["a"].year) * 12 + r["b"].month - r["a"].month
        assert r["c"] == cal and r["l"] == max(cal, 0)
        assert r["f"] == completed_months(r["a"], r["b"]), (r["a"], r["b"], r["f"])


@SETTINGS
@given(st.lists(st.one_of(st.from_regex(r"[0-9]{8}", fullmatch=True), st.from_regex(r"[0-9]{1,9}", fullmatch=True)),
                min_size=1, max_size=200))
def test_compact_dates(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select("v", dates.parse_yyyymmdd("v").alias("d")).collect():
        try:
            want = dt.datetime.strptime(r["v"], "%Y%m%d").date() if len(r["v"]) == 8 else None
        except ValueError:
            want = None
        assert r["d"] == want, r["v"]


CODES = st.sampled_from(["m", "M", " f", "F ", "male", "FEMALE", "n/a", "NAS", "x", "", "\tm\n", "Female "])


@SETTINGS
@given(st.lists(st.one_of(CODES, st.none()), min_size=1, max_size=100))
def test_gender_recode(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select("v", text.recode("v", config.GENDER_CODES, config.GENDER_NULL_CODES).alias("g")).collect():
        if r["v"] is None:
            assert r["g"] is None
            continue
        key = r["v"].strip().upper()
        want = None if key in config.GENDER_NULL_CODES else config.GENDER_CODES.get(key, key)
        assert r["g"] == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-50, 1500)), min_size=1, max_size=200))
def test_cost_ranges(spark, costs):
    df = spark.createDataFrame([(c,) for c in costs], "c int")
    below, low, mid, above = binning.cost_range_labels(DEFAULT.cost_bounds)
    for r in df.select("c", binning.cost_range("c", DEFAULT.cost_bounds).alias("r")).collect():
        c = r["c"]
        want = (above if c is None else below if c < 100 else low if c <= 500 else mid if c <= 1000 else above)
        assert r["r"] == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-5, 120)), min_size=1, max_size=200))
def test_age_groups(spark, ages):
    df = spark.createDataFrame([(a,) for a in ages], "a int")
    for r in df.select("a", binning.age_group("a").alias("g")).collect():
        a = r["a"]
        want = next((label for lo, hi, label in config.AGE_BINS if a is not None and lo < a <= hi),
                    config.UNKNOWN_TEXT)
        assert r["g"] == want
