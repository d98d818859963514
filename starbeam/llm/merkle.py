"""Merkle manifest of a dataset with inclusion proofs by pointer jumping.

Every row is a leaf: the SHA-256 of its fields. The leaves of a group (a source), in order of id,
are the bottom level of the group's tree; every ``ARITY`` consecutive nodes of a level become one
node of the next, their digests hashed together, until one is left, the group's subroot. The
subroots in order of group are the leaves of one more tree, whose top is the root of the dataset.

1. Positions. Leaves are range-partitioned and sorted by group and id and written with their place in
   the partition; the runs of a group in each partition (one row each) give the offsets. A
   group of any size is spread over as many partitions as its rows need.
2. Tree. Blocks of ``ARITY ** LEVELS`` neighbouring nodes are gathered and give ``LEVELS`` levels at once, so a
   tree over n leaves takes log n / log 729 shuffles, each 729 times smaller than the one before.
3. Proofs by pointer jumping. A node first holds one segment, its siblings in its own run, and points
   at its parent. A self-join on (tree, level, position) fetches the segment of the ancestor pointed
   at, appends it and doubles the distance: 1, 2, 4 ... levels. Only nodes whose level is a multiple
   of the distance are needed later, so the inner nodes of a round are a ninth, an 81st ... of the
   leaves. The last join appends the path of the group's subroot to the root.

A proof is the list of (left, right) siblings from the leaf up, and ``folded`` recomputes the root from
any leaf digest and a proof.

Defined results: null fields are hashed as ``-`` (an empty text as ``0:``); a null group is a group of its
own and comes first; null ids come first in their group; rows that repeat an id are ordered by their
digests, so equal rows hold neighbouring places; a group of one row is its own subroot and a dataset of
one group has that group's subroot as root; an empty table gives an empty manifest; further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starbeam.llm import common

ARITY, LEVELS = 3, 6
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:binary,right:binary>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value's text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (with column ``tree``) plus ``idx``, the position in the tree by ``order``, and ``n``, the tree's leaves."""
    ranged = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = common.written(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("size").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = ranged.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    runs = common.written(runs.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("size").over(whole).alias("n")))
    return ranged.join(runs, ["tree", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _next_level(digests: Column) -> Column:
    def node(i: Column) -> Column:
        return F.unhex(F.sha2(F.concat(*[F.coalesce(_hex(F.get(digests, i * ARITY + k)), F.lit("")) for k in range(ARITY)]), 256))

    return F.transform(F.sequence(F.lit(0), ((F.size(digests) + ARITY - 1) / ARITY).cast("int") - 1), node)


def _levels(digests: Column, n: Column) -> Column:
    """Up to ``LEVELS + 1`` levels over a block; a block that holds its whole level stops at one node."""

    def grow(levels: Column, _: Column) -> Column:
        top = F.element_at(levels, -1)
        return F.when((n <= BLOCK) & (F.size(top) == 1), levels).otherwise(F.concat(levels, F.array(_next_level(top))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), F.array(digests), grow)


def _siblings(digests: Column, i: Column) -> Column:
    """(left, right): the digests before and after place ``i`` in its run."""
    none = F.lit(b"")
    at = i % ARITY

    def near(k: int) -> Column:
        return F.coalesce(F.get(digests, i + k), none)

    left = F.concat(*[F.when(at >= k, near(-k)).otherwise(none) for k in range(ARITY - 1, 0, -1)])
    right = F.concat(*[F.when(at + k < ARITY, near(k)).otherwise(none) for k in range(1, ARITY)])
    return F.struct(left.alias("left"), right.alias("right"))


def _raised(level: Column) -> Column:
    """``ARITY ** (LEVELS - level)``."""
    return F.get(F.array(*[F.lit(ARITY ** (LEVELS - k)) for k in range(LEVELS + 1)]), level)


def forest(leaves: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """((payload, ``tree``, ``path`` to the tree's root) of every leaf, (``tree``, ``root``)) for leaves (``tree``, ``digest``, payload)."""
    payload = [c for c in leaves.columns if c not in ("tree", "digest")]
    nodes = _placed(leaves, order)
    rows = inner = roots = None
    height, level = 0, 0
    while True:
        block = F.expr(f"idx div {BLOCK}").alias("block")
        kept = [F.col(c) for c in payload] if level == 0 else []
        gathered = nodes.groupBy("tree", block).agg(F.sort_array(F.collect_list(F.struct("idx", "digest", *kept))).alias("nodes"), F.min("n").alias("n"))
        gathered = gathered.select("*", _levels(F.transform("nodes", lambda x: x["digest"]), F.col("n")).alias("levels"))
        gathered = common.written(gathered)
        if level == 0:
            at_leaf = gathered.select("tree", "levels", F.posexplode("nodes").alias("i", "leaf"))
            path = F.when(F.size("levels") > 1, F.array(_siblings(F.col("levels")[0], F.col("i")))).otherwise(F.array().cast(PATH))
            rows = at_leaf.select("tree", F.col("leaf.idx").alias("idx"), *[F.col(f"leaf.{c}").alias(c) for c in payload], path.alias("path"))
        first = 1 if level == 0 else 0
        each = F.transform(F.slice("levels", 1, F.size("levels") - 1), lambda digests, k: F.transform(digests, lambda _, i: F.struct(
            (k + level).alias("level"), (F.col("block") * _raised(k) + i).alias("idx"), F.array(_siblings(digests, i)).alias("path"))))
        own = gathered.where(F.size("levels") > first + 1).select("tree", F.explode(F.flatten(F.slice(each, first + 1, LEVELS))).alias("node")).select("tree", "node.*")
        inner = own if inner is None else inner.unionByName(own)
        top = F.element_at(F.element_at("levels", -1), 1)
        done = gathered.where(F.col("n") <= BLOCK).select("tree", top.alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        height = max(height, level + (gathered.agg(F.max(F.size("levels"))).first()[0] or 1) - 1)
        above = gathered.where(F.col("n") > BLOCK).select("tree", F.col("block").alias("idx"), top.alias("digest"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"))
        if above.isEmpty():
            return _jumped(rows, inner, height).drop("idx"), roots
        nodes, level = above, level + LEVELS


def _jumped(rows: DataFrame, inner: DataFrame, height: int) -> DataFrame:
    """``rows`` with paths to the root, by self-joins that double the distance to the ancestor pointed at."""
    state, distance = inner, 1
    while distance < height:
        state = common.written(state)
        reached = state.select(F.col("tree").alias("a_tree"), F.col("level").alias("a_level"), F.col("idx").alias("a_idx"), F.col("path").alias("a_path"))
        up = F.expr(f"idx div {ARITY**distance}")
        joined = F.concat("path", F.coalesce("a_path", F.array().cast(PATH))).alias("path")
        ancestors = reached.where(F.col("a_level") == distance)
        others = [c for c in rows.columns if c != "path"]
        rows = rows.join(ancestors, (F.col("tree") == F.col("a_tree")) & (up == F.col("a_idx")), "left").select(*others, joined)
        left = state.where(F.col("level") % (2 * distance) == 0)
        right = reached.where(F.col("a_level") % (2 * distance) == distance)
        same = (F.col("tree") == F.col("a_tree")) & (F.col("level") + distance == F.col("a_level")) & (up == F.col("a_idx"))
        state = left.join(right, same, "left").select("tree", "level", "idx", joined)
        distance *= 2
    return rows


def folded(digest: Column, path: Column) -> Column:
    """Root as lowercase hex, recomputed from a leaf digest (hex) and its proof."""
    return F.aggregate(path, digest, lambda own, s: F.sha2(F.concat(_hex(s["left"]), own, _hex(s["right"])), 256))


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "source",
    fields: tuple[str, ...] = FIELDS,
    altered: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: id, ``leaf``, ``subroot``, ``root`` (hex), ``path`` (siblings from the leaf to the root, binary) and, where
    ``altered`` replaces fields by expressions, ``altered_leaf``, the digest of the row with these (null if it is the same)."""
    leaf = leaf_digest([F.col(c) for c in fields])
    other = leaf_digest([(altered or {}).get(c, F.col(c)) for c in fields]) if altered else F.lit(None).cast("string")
    # a null group sorts before every other and joins like them
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = docs.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf.alias("leaf"), other.alias("other"))
    same = F.col("other").isNull() | (F.col("other") == F.col("leaf"))
    digests = leaves.select("tree", "id", F.unhex("leaf").alias("digest"), F.when(~same, F.unhex("other")).alias("other"))
    digests = common.written(digests.withColumn("leaf", F.col("digest")))
    rows, subroots = forest(digests, ["id", "digest"])
    tops = common.written(subroots.select(F.lit("").alias("tree"), F.col("root").alias("digest"), F.col("tree").alias("group"), F.col("root").alias("subroot")))
    tops, roots = forest(tops, ["group"])
    found = roots.first()
    root = found["root"].hex() if found else None
    tops = common.written(tops.select("group", "subroot", F.col("path").alias("top_path")))
    whole = rows.join(tops, F.col("tree") == F.col("group"))
    return whole.select(
        F.col("id").alias(id_col),
        _hex(F.col("leaf")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        F.lit(root).cast("string").alias("root"),
        F.concat("path", "top_path").alias("path"),
        _hex(F.col("other")).alias("altered_leaf"),
    )


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digest columns: leaf, subroot, root, hash of the proof, the root folded from the altered leaf, and whether it is the root."""
    siblings = F.array_join(F.transform("path", lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "")
    again = folded(F.coalesce("altered_leaf", "leaf"), F.col("path"))
    rows = found.select(id_col, "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), again.alias("folded_root"))
    return rows.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


def line_breaks_deleted(id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """Tampering for a test of the proofs: rows whose crc32(id as text) is even lose their line breaks."""
    even = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return {text_col: F.when(even, F.replace(F.col(text_col), F.lit("\n"), F.lit(""))).otherwise(F.col(text_col))}


_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


def _sql_leaf(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return "sha256(" + " || ".join(parts) + ")"


_SQL_TREE = """
{name}_nodes AS (
  SELECT tree, key, 0 AS level, row_number() OVER (PARTITION BY tree ORDER BY key NULLS FIRST) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n, digest FROM {leaves}
  UNION ALL
  SELECT tree, NULL, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM {name}_nodes WHERE n > 1 GROUP BY tree, level, idx // 3, n
),
{name}_segments AS (
  SELECT tree, key, level, idx, n, digest,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}_nodes WINDOW run AS (PARTITION BY tree, level, idx // 3 ORDER BY idx)
),
{name}_climb AS (
  SELECT tree, key, level, idx, n, '' AS proof, folded FROM (SELECT s.*, f.folded FROM {name}_segments s JOIN {leaves} f ON s.level = 0 AND s.tree IS NOT DISTINCT FROM f.tree AND s.key IS NOT DISTINCT FROM f.key)
  UNION ALL
  SELECT c.tree, c.key, c.level + 1, c.idx // 3, (c.n + 2) // 3, c.proof || s.l || s.r, sha256(s.l || c.folded || s.r)
  FROM {name}_climb c JOIN {name}_segments s ON s.tree IS NOT DISTINCT FROM c.tree AND s.level = c.level AND s.idx = c.idx WHERE c.n > 1
),
{name}_done AS (
  SELECT c.tree, c.key, c.proof, c.folded, t.digest AS root FROM {name}_climb c JOIN {name}_nodes t ON c.n = 1 AND t.n = 1 AND t.tree IS NOT DISTINCT FROM c.tree
)"""

ORACLE_SQL = (
    "WITH RECURSIVE docs AS (SELECT doc_id AS key, source AS tree, "
    + _sql_leaf("text")
    + " AS digest, CASE WHEN "
    + _CRC32
    + " % 2 = 0 THEN "
    + _sql_leaf("replace(text, chr(10), '')")
    + " ELSE "
    + _sql_leaf("text")
    + " END AS folded FROM documents),"
    + _SQL_TREE.format(name="doc", leaves="docs")
    + ", tops AS (SELECT DISTINCT 0 AS tree, tree AS key, root AS digest, root AS folded FROM doc_done),"
    + _SQL_TREE.format(name="top", leaves="tops")
    + """, up AS (
  SELECT d.key, d.tree, d.root AS subroot, d.proof || t.proof AS proof, t.root AS root, d.folded AS folded FROM doc_done d JOIN top_done t ON t.key IS NOT DISTINCT FROM d.tree
), last AS (
  select u.key, u.tree, 0 AS level, row_number() OVER () AS no, s.idx AS idx, s.n AS n, u.folded AS folded FROM up u JOIN top_segments s ON s.level = 0 AND s.key IS NOT DISTINCT FROM u.tree
  UNION ALL
  SELECT c.key, c.tree, c.level + 1, c.no, c.idx // 3, (c.n + 2) // 3, sha256(s.l || c.folded || s.r) FROM last c JOIN top_segments s ON s.level = c.level AND s.idx = c.idx WHERE c.n > 1
)
SELECT u.key AS doc_id, f.digest AS leaf, u.subroot AS subroot, u.root AS root, sha256(u.proof) AS proof_sha256, l.folded AS folded_root, l.folded = u.root AS verified
FROM up u JOIN docs f ON f.key IS NOT DISTINCT FROM u.key AND f.tree IS NOT DISTINCT FROM u.tree
JOIN last l ON l.n = 1 AND l.key IS NOT DISTINCT FROM u.key AND l.tree IS NOT DISTINCT FROM u.tree"""
)
