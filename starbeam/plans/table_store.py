"""Tables that are replaced as a whole or not at all (SNK1).

A table is a folder with one folder for each version and a file ``CURRENT`` that names the one to read.
A new version is written beside the old one and published by renaming a new ``CURRENT`` over the old,
a single step of the file system; a write that fails before that leaves the table as it was. The second line of
``CURRENT`` is a note about the version (JSON), published in the same step. The version
before is kept for readers that still hold it; older and unfinished ones are removed at the next replace.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

CURRENT = "CURRENT"


def _hadoop(spark: SparkSession, path: str):
    """(JVM's org.apache.hadoop.fs package, path as a Hadoop path, its file system, configuration)."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    where = fs.Path(path)
    return fs, where, where.getFileSystem(conf), conf


def current(spark: SparkSession, path: str) -> tuple[str | None, dict]:
    """(name of the published version, its note); (None, {}) where none is."""
    fs, where, system, _ = _hadoop(spark, f"{path}/{CURRENT}")
    if not system.exists(where):
        return None, {}
    version, _, note = spark.read.text(f"{path}/{CURRENT}", wholetext=True).first()[0].partition("\n")
    return version.strip(), json.loads(note) if note.strip() else {}


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the published version, None where none is."""
    return current(spark, path)[0]


def table_path(spark: SparkSession, path: str) -> str:
    """Folder of the published version; the folder itself for a table without versions."""
    version = current_version(spark, path)
    return f"{path}/{version}" if version else path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(table_path(spark, path))


def _publish(spark: SparkSession, path: str, version: str, note: dict) -> None:
    fs, target, system, conf = _hadoop(spark, f"{path}/{CURRENT}")
    draft = fs.Path(f"{path}/.{CURRENT}-{uuid.uuid4().hex}")
    out = system.create(draft, True)
    out.write(bytearray(f"{version}\n{json.dumps(note)}".encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    overwrite[0] = getattr(fs, "Options$Rename").OVERWRITE
    fs.FileContext.getFileContext(system.getUri(), conf).rename(system.makeQualified(draft), system.makeQualified(target), overwrite)


def replace_table(spark: SparkSession, path: str, df: DataFrame, partition_by: str | None = None, note: Callable[[], dict] | None = None) -> DataFrame:
    """Write ``df`` as the table's new version, publish it, remove what is older than the version before; the stored table.
    ``note`` gives the version's note once its rows are written (so it may hold what was observed meanwhile)."""
    before, version = current_version(spark, path), f"v-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{path}/{version}")
    _publish(spark, path, version, note() if note else {})
    fs, where, system, _ = _hadoop(spark, path)
    for status in system.listStatus(where):
        name = status.getPath().getName()
        if name not in (version, before, CURRENT) and not name.startswith("."):
            system.delete(status.getPath(), True)
    return spark.read.parquet(f"{path}/{version}")
