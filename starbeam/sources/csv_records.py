"""Records of CSV files whose quoted fields hold line breaks, found in parallel.

A file is read as lines, split by bytes like any text file. Whether a line begins inside a quoted field
depends on all lines before it, but every line acts on that state as one of four functions: it leaves
it, turns it, or ends outside or inside whatever it was. Functions compose, so a prefix scan on two
levels finds the state before every line: over the lines of a split, and over the splits of a file
(one row a split). The same two levels number the records. A record of one line is complete as it is;
only the lines of longer records are brought together.

A quote opens a field at the field's beginning only, and a doubled quote stands for one, as in the
one-task reader. Lines end with a line feed or carriage return and line feed, read as a line feed inside a field. A file with an
unclosed quote is one record from there to its end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _opens(text: Column) -> Column:
    """1 if a line read from outside a quoted field ends inside one (doubled quotes taken out before)."""
    rest = F.regexp_replace(text, r'(^|,)"[^"]*"(?=,|\z)', "$1")
    return rest.rlike(r'(^|,)"[^"]*\z').cast("int")


def _xor(a: Column, b: Column) -> Column:
    return (a + b) % 2


def _scanned(rows: DataFrame, order: list, by: list[str]) -> DataFrame:
    """Adds ``known`` and ``turned``, the composed function of a row and all before it, and the same before the row (``was_known``,
    ``was_turned``). The state after it is ``known``, or where that is null the first state turned ``turned`` times."""
    each = Window.partitionBy(*by).orderBy(*order)
    upto = each.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixed = F.col("from_out") == F.col("from_in")
    turns = F.when(~fixed & (F.col("from_out") == 1), 1).otherwise(0)
    rows = rows.withColumn("turned", (F.sum(turns).over(upto) % 2).cast("int"))
    at_fixed = F.last(F.when(fixed, _xor(F.col("from_out"), F.col("turned"))), ignorenulls=True).over(upto)
    rows = rows.withColumn("known", _xor(at_fixed, F.col("turned")))
    return rows.select("*", F.lag("known").over(each).alias("was_known"), F.lag("turned", 1, 0).over(each).alias("was_turned"))


def _after(first: Column, known: str, turned: str) -> Column:
    return F.coalesce(F.col(known), _xor(first, F.col(turned)))


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, at, line): the lines of all files, ``at`` ascending within a split."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.input_file_name().alias("file"), F.input_file_block_start().alias("split"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, no, record): the records of every file, numbered from 0; empty lines between records are left out."""
    plain = F.regexp_replace("line", r"\r\z", "")
    bare = F.replace(plain, F.lit('""'), F.lit(""))
    closed = F.concat(F.lit("x"), F.regexp_replace(bare, r'^[^"]*"', ""))
    lines = csv_lines(spark, path).select(
        "*", _opens(bare).alias("from_out"), F.when(F.contains(bare, F.lit('"')), _opens(closed)).otherwise(1).alias("from_in"), (F.length(plain) == 0).alias("empty")
    )
    lines = _scanned(lines, ["at"], ["file", "split"])

    def begins(first: Column) -> Column:
        return ((_after(first, "was_known", "was_turned") == 0) & ~F.col("empty")).cast("int")

    ends = F.max_by(F.struct("known", "turned"), F.col("at")).alias("end")
    splits = lines.groupBy("file", "split").agg(ends, F.sum(begins(F.lit(0))).alias("n_out"), F.sum(begins(F.lit(1))).alias("n_in"))
    splits = splits.select("file", "split", "n_out", "n_in", *[F.coalesce("end.known", _xor(F.lit(s), F.col("end.turned"))).alias(name) for s, name in ((0, "from_out"), (1, "from_in"))])
    splits = _scanned(splits, ["split"], ["file"])
    first = _after(F.lit(0), "was_known", "was_turned")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    number = F.when(first == 0, F.col("n_out")).otherwise(F.col("n_in"))
    splits = splits.withColumn("first", first).withColumn("records", number).select(
        F.col("file").alias("in_file"), F.col("split").alias("in_split"), "first", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("offset")
    )
    placed = lines.join(splits, (F.col("file") == F.col("in_file")) & (F.col("split") == F.col("in_split")))
    begin, inside = _after(F.col("first"), "was_known", "was_turned"), _after(F.col("first"), "known", "turned")
    upto = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.select("file", "split", "at", "line", "empty", begin.alias("begin"), inside.alias("inside"), "offset", begins(F.col("first")).alias("new"))
    placed = placed.withColumn("no", F.col("offset") + F.sum("new").over(upto) - 1).where("not (empty and begin = 0)")
    alone = F.col("begin") + F.col("inside") == 0
    short = placed.where(alone).select("file", "no", "line")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("split", "at", "line"))), lambda x: F.regexp_replace(x["line"], r"\r\z", ""))
    long = placed.where(~alone).groupBy("file", "no").agg(F.array_join(parts, "\n").alias("line"))
    record = F.regexp_replace(plain, "^﻿", "")
    return short.unionByName(long).select("file", "no", F.when(F.col("no") == 0, record).otherwise(plain).alias("record"))
