"""Fingerprints of what a stored table was made from, so that a restarted run can take it as it is (SNK3).

A fingerprint covers the input files (path, length, time of change), the plan over them, the fingerprints of the
stored tables it reads, the parameters and this package's code. Equal fingerprints mean equal rows; what has
none (rows that only live in the session) is always written anew.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Folders whose code decides the rows of the warehouse.
_CODE = ("functions", "operators", "plans", "sources")
# Leaves of a plan whose rows are told by its text and its files.
_KNOWN_LEAVES = ("LogicalRelation", "OneRowRelation", "Range")


def digest(*parts) -> str | None:
    """One fingerprint of several parts; none if any part has none."""
    if any(p is None for p in parts):
        return None
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=repr).encode()).hexdigest()


@lru_cache(maxsize=1)
def code() -> str:
    """The package's own files, without the training-data operators."""
    root = Path(__file__).resolve().parents[1]
    files = [root / "config.py", *(f for d in _CODE for f in sorted((root / d).rglob("*.py")))]
    return digest(*[hashlib.sha256(f.read_bytes()).hexdigest() for f in files])


def files(spark: SparkSession, paths) -> str:
    """Name, length and time of change of files, folders with all that is in them; each folder is listed once."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in sorted(paths):
        where = fs.Path(path)
        listed = where.getFileSystem(conf).listFiles(where, True)
        while listed.hasNext():
            status = listed.next()
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return digest(sorted(found))


def frame(df: DataFrame) -> str | None:
    """The plan of a frame over files, and those files; None where a leaf of the plan is no file relation."""
    spark = df.sparkSession
    try:
        analyzed = df._jdf.queryExecution().analyzed()
    except Exception:  # Spark Connect: no plan on this side
        return None
    leaves = analyzed.collectLeaves()
    if any(leaves.apply(i).getClass().getSimpleName() not in _KNOWN_LEAVES for i in range(leaves.size())):
        return None
    shown = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(shown)
    spark.conf.set(shown, "100000")
    try:
        text = re.sub(r"#\d+L?", "", analyzed.toString())
    finally:
        spark.conf.set(shown, before)
    return digest(text, files(spark, df.inputFiles()))
