"""The date form of a whole column, found by vote (CLN8).

``03/04/2012`` alone does not say which number is the day, but its column usually does: one value with a
number above 12 in first (or second) place settles it. ``vote`` counts the forms of all values in one aggregate;
every value of the column is then read in the form that has more votes, so equal texts give equal dates.
Votes are counted on the rows as they came, repeated ones included.

Defined results: ISO forms and ``yyyy/M/d`` are read in any column and do not vote; a column without a vote, or
with as many for either form, is read month-first and is ``ambiguous`` if it has a value that both forms
can read; a value that only the other form can read becomes null (and is counted by DQ10).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbeam.functions import dates

DAY, MONTH = "day", "month"

#: Counts of ``vote``, in output order.
COUNTS = ("missing", "year_first", "day_first", "month_first", "either", "unreadable")


def _kind(c: str) -> Column:
    """The form of a value of the column, as its place in ``COUNTS``; each way to read it is tried once."""
    text = F.trim(F.col(c).cast("string"))
    present = F.coalesce(text != "", F.lit(False))
    by_day, by_month = (dates.parse_numbers(text, order).isNotNull() for order in (DAY, MONTH))
    by_year = dates.parse_date(text, ("yyyy/M/d",)).isNotNull()
    place = {name: F.lit(i) for i, name in enumerate(COUNTS)}
    return (F.when(~present, place["missing"]).when(by_year, place["year_first"])
            .when(by_day, F.when(by_month, place["either"]).otherwise(place["day_first"]))
            .when(by_month, place["month_first"]).otherwise(place["unreadable"]))


def vote(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row a column: its counts, ``date_form`` (day or month) and ``ambiguous``; one aggregate over ``df``.
    The values of all columns are one column of rows, so the code that reads them does not grow with the columns
    (generated code beyond a size is not compiled by the JVM)."""
    values = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("no"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])))
    kinds = values.select("no", _kind("value").alias("kind"))
    sums = kinds.agg(*[F.count_if((F.col("no") == i) & (F.col("kind") == k)).alias(f"{name}_{i}") for i in range(len(columns)) for k, name in enumerate(COUNTS)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{name}_{i}").alias(name) for name in COUNTS]) for i, c in enumerate(columns)])
    day, month = F.col("day_first"), F.col("month_first")
    return sums.select(F.inline(rows)).select(
        "*", F.when(day > month, F.lit(DAY)).otherwise(F.lit(MONTH)).alias("date_form"), ((F.col("either") > 0) & (day == month)).alias("ambiguous"))


def forms_of(votes: DataFrame) -> Column:
    """The votes as one value (a map from column to form) that a plan over the same rows can use: no job runs before it does."""
    return votes.agg(F.map_from_entries(F.collect_list(F.struct("column_name", "date_form")))).scalar()


def read_by_vote(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with each of ``columns`` as dates in the form that its own values have."""
    if not columns:
        return df
    forms = forms_of(vote(df, columns))
    return df.withColumns({c: dates.parse_in_form(c, forms[c]) for c in columns})
