"""Spark helpers that the operators of this package share."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from starbeam.operators.keys import surrogate_key
from starbeam.session import ensure_checkpoint_dir


_shipped: set[str] = set()


#: Most bytes of an Arrow batch: long texts make batches shorter than the default number of rows.
BATCH_BYTES = 32 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python path, once per application, and bound the bytes of Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix=f"{root.name}-"), f"{root.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(application)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow(function, schema)`` with this package on the executors' path."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder; later steps read the files, so a lost executor costs no recomputing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again, so that later plans know its size."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def told_apart(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """(docs, column that tells every row apart): the id where it is never null and never repeated, else a number in
    order of id (null last) and text that the returned table has as one more column."""
    if docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("rows of an id")).where((F.col("`rows of an id`") > 1) | F.col(id_col).isNull()).isEmpty():
        return docs, id_col
    name = f"row_of_{id_col}"
    while name in docs.columns:
        name += "_"
    return surrogate_key(docs, [F.col(id_col).asc_nulls_last(), F.xxhash64(text_col)], name), name


def model_file(path: str, most: int = 32 << 20) -> bytes:
    """A vocabulary file as bytes, sent to the tasks by value so that executors need no local copy; at most 32 MB."""
    size = os.path.getsize(path)
    if size > most:
        raise ValueError(f"{path} has {size} bytes; at most {most} are sent to the tasks")
    with open(path, "rb") as f:
        return f.read()


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
