"""Bronze sources: raw CSV files read as they are (SRC1-SRC3).

Every field is read as text with an explicit schema (no inference pass over the
data); the null markers of the original reader become SQL NULL; padding such as
``'R '`` is kept. Quoted fields may hold commas, doubled quotes and line breaks. A row
with too few or too many fields is kept as far as it can be read and its text stands
in ``BAD_ROW``, so it can be counted. A missing file is recorded and the remaining files
still load.
"""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starbeam import config
from starbeam.sources.csv_records import csv_records
from starbeam.sources.schemas import RAW_FILES


def na_tokens_to_null(df: DataFrame, tokens=config.NA_TOKENS) -> DataFrame:
    """Turn the null markers (exact field text) of every string column into NULL."""
    tokens = list(tokens)
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.simpleString() == "string":
            c = F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


#: Bronze column with the text of a row that does not have the header's fields, else null.
BAD_ROW = "_bad_row"

CSV_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "inferSchema": "false",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             multi_line: bool = True, keep_bad_rows: bool = False, one_task: bool = False) -> DataFrame:
    """SRC1: header row, every field as text, padding kept, null markers -> NULL.

    Without ``schema`` the file's own header names are kept as they are (silver
    normalises them) and no inference pass runs. With ``schema`` the header must hold its
    names (compared case-insensitively, in any order); columns are taken by name.
    ``multi_line`` lets quoted fields hold line breaks; where a file is larger than a
    split its records are found in parallel (``csv_records``), unless ``one_task``.
    ``keep_bad_rows`` adds ``BAD_ROW``. A file whose header differs from the first one's fails the read.
    """
    reader = spark.read.options(**CSV_OPTIONS, multiLine=str(multi_line).lower())
    header = reader.csv(path).schema
    if schema is not None:
        given, own = ([f.name.strip().lower() for f in s.fields] for s in (schema, header))
        if sorted(given) != sorted(own):
            raise ValueError(f"{path}: the header has {own}, the schema {given}")
        types = {f.name.strip().lower(): f for f in schema.fields}
        header = StructType([types[name] for name in own])
    fields = header
    if keep_bad_rows:
        fields = StructType([*fields.fields, StructField(BAD_ROW, StringType(), True)])
    if multi_line and not one_task and _larger_than_a_split(spark, path):
        rows = _parsed(csv_records(spark, path), header, fields, keep_bad_rows)
    else:
        if keep_bad_rows:
            reader = reader.option("columnNameOfCorruptRecord", BAD_ROW)
        elif schema is not None:
            reader = reader.option("enforceSchema", "false")
        rows = reader.schema(fields).csv(path)
    if schema is not None:
        rows = rows.select(*[_quoted(f.name) for f in schema.fields], *([BAD_ROW] if keep_bad_rows else []))
    return na_tokens_to_null(rows)


def _larger_than_a_split(spark: SparkSession, path: str) -> bool:
    """Is a file of the path larger than what one task reads? (Files of one split are read by one task each anyway.)"""
    longest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    return (longest or 0) > int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _parsed(records: DataFrame, header: StructType, fields: StructType, keep_bad_rows: bool) -> DataFrame:
    """The records as columns; the first of each file is its header and must be that of the first file."""
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "inferSchema")} | {"multiLine": "true"}
    if keep_bad_rows:
        options["columnNameOfCorruptRecord"] = BAD_ROW
    names = StructType([StructField(f"c{i}", StringType()) for i in range(len(header.fields))])
    own = F.from_csv("record", names.toDDL(), options)
    # a repeated or empty name gets a number of its own from the reader: only its beginning is in the file
    same = F.lit(True)
    for i, f in enumerate(header.fields):
        same = same & F.coalesce(F.startswith(F.lit(f.name.strip().lower()), F.lower(F.trim(own[f"c{i}"]))), F.lit(True))
    differs = F.raise_error(F.concat(F.lit("header differs in "), F.col("file"))).cast("boolean")
    body = records.where(F.when(F.col("no") > 0, F.lit(True)).otherwise(F.when(same, F.lit(False)).otherwise(differs)))
    return body.select(F.from_csv("record", fields.toDDL(), options).alias("row")).select("row.*")


def _exists(spark: SparkSession, path: str) -> bool:
    """Path check through the Hadoop file system (works for local and remote stores)."""
    try:
        jvm = spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(jpath))
    except Exception:  # no JVM gateway: fall back to the local file system
        return os.path.exists(path)


@dataclass
class SourceLoad:
    """SRC3: loaded tables and the sources that could not be loaded."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    missing: dict[str, str] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return not self.missing


def load_sources(spark: SparkSession, root: str, files: Mapping[str, str] = RAW_FILES,
                 schemas: Mapping[str, StructType] | None = None) -> SourceLoad:
    """SRC2 + SRC3: read every source of the map; a missing file is recorded and
    the other sources still load (the run is marked failed by the caller)."""
    out = SourceLoad()
    for name, rel in files.items():
        path = rel if os.path.isabs(rel) or "://" in rel else os.path.join(root, rel)
        if not _exists(spark, path):
            out.missing[name] = path
            continue
        out.paths[name] = path
        out.tables[name] = read_csv(spark, path, schemas.get(name) if schemas else None, keep_bad_rows=True)
    return out
