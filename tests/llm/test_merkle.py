"""The manifest against a plain version of the same tree, and proofs that tell altered rows."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from starbeam.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """(root, proof of each leaf as a list of (left, right))."""
    proofs, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for p, i in zip(proofs, at):
            run = level[i // 3 * 3 : i // 3 * 3 + 3]
            p.append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        at = [i // 3 for i in at]
        level = [h("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return (level[0] if level else None), proofs


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = plain_tree([leaf(r) for r in groups[s]])
    root, tops = plain_tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for r, proof in zip(groups[s], trees[s][1]):
            whole = proof + top
            text = r[4].replace("\n", "") if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[4]
            own = leaf((*r[:4], text))
            for left, right in whole:
                own = h(left + own + right)
            out.append((r[0], leaf(r), trees[s][0], root, h("".join(a + b for a, b in whole)), own, own == root))
    return sorted(out, key=str)


def got(docs):
    return sorted((tuple(r) for r in merkle.report(merkle.manifest(docs, altered=merkle.line_breaks_deleted())).collect()), key=str)


MIXED = [
    (1, "b", "en", 3, "a\nb"), (2, "b", None, None, None), (3, None, "en", 0, ""), (4, None, "de", 1, "é"), (10, "a", "en", 2, "x\n" * 50_000),
    (9, "a", "en", 2, "same"), (9, "a", "en", 2, "same"), (9, "a", "en", 2, "other"), (None, "a", "en", 2, "no id\n"), (5, "é", "en", 1, "lone\n"),
]


@pytest.mark.parametrize("levels", [1, 6])
def test_equals_the_plain_tree(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", merkle.ARITY**levels)
    rows = MIXED + [(100 + i, "hot", "en", i, f"line {i}\n") for i in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(docs) == plain(rows)


@pytest.mark.parametrize("n", [1, 3, 4, 10])
def test_sizes_of_one_group(spark, n):
    rows = [(i, "s", "en", i, f"t{i}\n") for i in range(n)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert got(empty) == []
    rows = [(i, f"s{i % 2}", "en", i, f"t{i}\n") for i in range(7)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("tree", "idx", "n", "part", "at", "digest", "path", "root", "level", "block", "id", "group"):
        docs = docs.withColumn(name, F.lit("x"))
    assert got(docs) == plain(rows)


def test_only_altered_rows_fail(spark):
    rows = [(i, "s", "en", i, f"line {i}\nend") for i in range(50)]
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), altered={"text": F.when(F.col("doc_id") == 7, "forged").otherwise(F.col("text"))})
    assert [r.doc_id for r in merkle.report(found).where("not verified").collect()] == [7]


def test_equals_sql(spark, tables, sf_small):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_small}/documents.parquet'")
    want = sorted((tuple(r) for r in con.execute(merkle.ORACLE_SQL).fetchall()), key=str)
    assert got(tables("documents")) == want and len(want) == tables("documents").count()
