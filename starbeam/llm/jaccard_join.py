"""Exact Jaccard join of documents as a join in a metric space.

A document is the set of its distinct four-word shingles (words between ASCII white space, A-Z lower-cased; a
shorter text is one shingle of all its words). The Jaccard distance 1 - |x & y| / |x | y| is a metric, and
documents link at similarity of ``percent`` per cent or more, that is at distance t = 0.15 or less.

1. Equal sets are one node (their smallest id); everything below is on nodes.
2. Coarse regions. Unrelated texts are all at distance 1 from one another, so document pivots alone cannot
   divide a corpus: every text would lie on every border. The first pivots are therefore the empty
   set and single shingles. Distance to the empty set (in the symmetric difference) is the set's size:
   the triangle inequality gives bands of sizes, and a document goes to its own and the next. From a
   shingle's pivot {s} only the documents that hold s are nearer than 1; a linked partner lacks at most
   n - ceil(0.85 n) of a document's n shingles, so a document is replicated to the regions of one more than
   that many of its shingles in an order that is the same for all: first the ``MARKED`` share of all shingles
   (by their hash), rarest first, then others. Shingles that one document alone has make no region, so most
   texts without a partner drop out here, and frequent passages are hardly ever used.
3. Each region is drawn to the document of smallest id in it, its first document pivot; regions of the same
   pivot are one. A region of more than ``REGION_DOCS`` documents or ``REGION_BYTES`` is divided by ``PIVOTS`` document
   pivots into Voronoi cells. A document goes to the cell of its nearest pivot p and, by the triangle
   inequality, to that of q if d(x, q) <= d(x, p) + 2 t; texts at distance 1 from all pivots form a cell that
   takes those at 1 - t or more as well. Documents within t of a pivot are linked to it, so a cell whose members all
   are is settled; else those of them that are nearer to it than the nearest unlinked member less t leave.
   Cells are divided again until they are small. A region whose
   cells would not halve the pairs to compare is dealt to pairs of blocks, which are joined like small regions.
4. A small region is joined in one task by the same recursion, down to pairs of documents whose
   components still differ; the test is on whole numbers, 100 |x & y| >= percent |x | y|.
5. Links are joined to components by alternating stars.

A hash of 64 bits stands for a shingle and one of 128 bits for a set.

Defined results: null and empty texts (or white space alone) have an empty set and link with nothing; a
null id is returned with its count and a null component; rows that repeat an id are one document that links
with all that any of its texts links with (each row has its own count); an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starbeam.llm import common, near_dup
from starbeam.llm import textscan as ts

SHINGLE, PERCENT = 4, 85
#: Shingles whose hash is below this share of all hashes come first in the common order.
MARKED = np.uint64(3 << 60)
REGION_DOCS, REGION_BYTES, PIVOTS, LEAF = 256, 4 << 20, 8, 24

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    words, starts, _ = ts.scan_words(data, offsets[:-1], ts.NOT_SPACE, ts.LOWER)
    first = ts.rows_of(starts, offsets)
    out = []
    with np.errstate(over="ignore"):
        # one pass for all texts: a window that crosses a text's end is not used
        n = len(words)
        h = np.zeros(max(n - size + 1, 0), np.uint64)
        for k in range(size):
            h = ts.mix(h + words[k : k + len(h)] * _FACTORS[k % 4] + np.uint64(k))
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= size:
                out.append(np.unique(h[a : b - size + 1]))
            elif b > a:
                whole = hashlib.blake2b(words[a:b].tobytes(), digest_size=8).digest()
                out.append(np.frombuffer(whole, np.uint64))
            else:
                out.append(h[:0])
    return out


def least_overlap(n, percent: int = PERCENT):
    """Shingles that a set of n must share with a linked one."""
    return (n * percent + 99) // 100


def order_tokens(own: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """(all marked shingles and as many others as the window needs, number of marked ones) of a sorted set."""
    marked = int(np.searchsorted(own, MARKED))
    need = len(own) - int(least_overlap(len(own), percent)) + 1
    return own[: max(marked, need)], marked


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("print"), text.alias("text"))


def sketches(docs: DataFrame, id_col: str, text_col: str, percent: int = PERCENT) -> DataFrame:
    """(no, id, print, n, key, marked, tokens) of every row: a row number, a hash of the text, the size and key of its set and its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in ts.text_groups(batch, "text"):
                sets = shingle_sets(data, offsets)
                tokens = [order_tokens(s, percent) if len(s) else (s, 0) for s in sets]
                ends = np.concatenate([[0], np.cumsum([len(t) for t, _ in tokens])]).astype(np.int32)
                flat = np.concatenate([t for t, _ in tokens]).view(np.int64)
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                columns = [part.column("id"), part.column("print"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array([m for _, m in tokens], pa.int32())]
                yield pa.record_batch([*columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["id", "print", "n", "key", "marked", "tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    own = common.map_arrow(_texts(docs, id_col, text_col), run, f"id {kind}, print long, n long, key binary, marked int, tokens array<long>")
    return own.select(F.monotonically_increasing_id().alias("no"), "*")


def windows(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, n, s): the shingles to whose regions each node (id, n, marked, tokens) goes; shingles of one node alone are left out."""
    tokens = nodes.select("id", F.posexplode("tokens").alias("at", "s"), "marked")
    tokens = tokens.select("id", "s", (F.col("at") >= F.col("marked")).alias("extra"))
    shared = tokens.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # one plan at every size: both sides are as large as the corpus
    held = tokens.join(shared.hint("merge"), "s").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("extra", "df", "s"))).alias("held"))
    held = held.join(nodes.select("id", "n", "marked"), "id")
    first = F.filter("held", lambda t: ~t["extra"])
    need = F.col("n") - F.expr(f"(n * {percent} + 99) div 100") + 1
    alone = F.col("marked") - F.size(first)
    take = F.greatest(need - alone, F.lit(0)).cast("int")
    chosen = F.concat(F.slice(first, 1, take), F.filter("held", lambda t: t["extra"]))
    return held.select("id", "n", F.explode(chosen).alias("t")).select("id", "n", F.col("t.s").alias("s"))


def coarse_regions(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(region, id): every two nodes that may link share a region; regions of one node are left out."""
    # the width is a hair above the ratio, so rounding cannot put a partner two bands away
    width = math.log(100 / percent) * (1 + 1e-9) + 1e-9
    band = F.floor(F.log("n") / width).cast("int")
    entries = windows(nodes, percent).select("id", "s", F.posexplode(F.array(band, band + 1)).alias("up", "band"))
    entries = common.written(entries)
    # the larger set of a pair is in its own band: a region where all are from the band below holds no pair of its own
    drawn = entries.groupBy("s", "band").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("size"), F.min("up").alias("up"))
    drawn = drawn.where("size > 1 and up = 0").select("s", "band", "pivot")
    return entries.join(drawn.hint("merge"), ["s", "band"]).select(F.concat_ws(":", "band", "pivot").alias("region"), "id").distinct()


def linked(a: int, b: int, both: np.ndarray, percent: int = PERCENT):
    """Do sets of sizes a and b with ``both`` common members reach the threshold?"""
    return (100 * both >= percent * (a + b - both)) & (both > 0)


class _Region:
    """Sets of one region, joined in one task; ``links`` are the pairs that joined two components."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent, self.t = percent, 1 - percent / 100
        self.size = np.array([len(s) for s in sets], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        _, self.item = np.unique(np.concatenate(sets), return_inverse=True)
        self.items = int(self.item.max()) + 1 if len(self.item) else 0
        self.parent = list(range(len(sets)))
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def roots(self, rows: np.ndarray) -> np.ndarray:
        return np.array([self.root(x) for x in rows.tolist()], np.int64)

    def common(self, pivot: int, rows: np.ndarray) -> np.ndarray:
        """|pivot & x| for each row x."""
        mark = np.zeros(self.items, np.int64)
        mark[self.item[self.first[pivot] : self.first[pivot + 1]]] = 1
        hits = mark[ts.take_ranges(self.item, self.first[rows], self.size[rows])]
        ends = np.cumsum(self.size[rows])
        return np.diff(np.concatenate([[0], np.cumsum(hits)])[np.concatenate([[0], ends])])

    def join_to(self, pivot: int, rows: np.ndarray, both: np.ndarray) -> None:
        for x in rows[linked(self.size[pivot], self.size[rows], both, self.percent)].tolist():
            a, b = self.root(pivot), self.root(x)
            if a != b:
                self.parent[a] = b
                self.links.append((pivot, x))

    def distances(self, pivot: int, rows: np.ndarray) -> np.ndarray:
        both = self.common(pivot, rows)
        self.join_to(pivot, rows, both)
        return 1 - both / np.maximum(self.size[pivot] + self.size[rows] - both, 1)

    def join(self, rows: np.ndarray) -> None:
        """All links among ``rows``, by cells of pivots, cells of these, and at last by pairs."""
        pending = [rows]
        while pending:
            rows = pending.pop()
            if len(rows) < 2 or len(np.unique(self.roots(rows))) == 1:
                continue
            if len(rows) <= LEAF:
                self.pairs(rows)
                continue
            pivots = rows[np.linspace(0, len(rows) - 1, min(PIVOTS, len(rows) // 4)).astype(np.int64)]
            d = np.stack([self.distances(p, rows) for p in pivots.tolist()])
            cells = [rows[c] for c in cells_of(d, self.t)]
            if 2 * sum(len(c) ** 2 for c in cells) > len(rows) ** 2:
                self.pairs(rows)
            else:
                pending.extend(cells)

    def pairs(self, rows: np.ndarray) -> None:
        """Every pair of rows that may link and is not joined yet."""
        rows = rows[np.argsort(self.size[rows], kind="stable")]
        for k, x in enumerate(rows.tolist()):
            later = rows[k + 1 :]
            later = later[self.size[later] * self.percent <= self.size[x] * 100]
            later = later[self.roots(later) != self.root(x)]
            if len(later):
                self.join_to(x, later, self.common(x, later))


def cells_of(d: np.ndarray, t: float) -> list[np.ndarray]:
    """The rows of each pivot's cell, from the matrix of distances (pivot, row): natives, and what a border or a rest needs."""
    best = d.min(axis=0)
    near = 1e-9
    cells = [np.flatnonzero((d[k] < 1) & (d[k] <= best + 2 * t + near)) for k in range(len(d))]
    return [*cells, np.flatnonzero(best >= 1 - t - near)]


def region_links(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs of sets that link, enough to join all components of the region."""
    region = _Region(sets, percent)
    region.join(np.flatnonzero(region.size > 0))
    return region.links


def _sets(texts: pa.Array) -> list[np.ndarray]:
    out = []
    for _, data, offsets in ts.text_groups(pa.record_batch([texts], names=["text"]), "text"):
        out += shingle_sets(data, offsets)
    return out


def _by_unit(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(table of one unit)`` (record batches out) for all rows of each (region, unit), which are few by construction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            here = pa.Table.from_batches([batch])
            held = here if held is None else pa.concat_tables([held, here])
            cuts = _unit_starts(held)
            for a, b in zip(cuts[:-1], cuts[1:-1] if len(cuts) > 1 else []):
                yield from work(held.slice(a, b - a))
            held = held.slice(cuts[-2]).combine_chunks() if len(cuts) > 1 else held
        if held is not None and held.num_rows:
            cuts = _unit_starts(held)
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield from work(held.slice(a, b - a))

    dealt = rows.repartition("region", "unit").sortWithinPartitions("region", "unit", "role", "id")
    return common.map_arrow(dealt, run, schema)


def _unit_starts(held: pa.Table) -> list[int]:
    """Where each (region, unit) of sorted rows begins, and the number of rows."""
    keys = [held.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("region", "unit")]
    edge = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
    return [0, *(np.flatnonzero(edge) + 1).tolist(), held.num_rows]


def _join_units(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within units of whole small regions."""

    def work(unit: pa.Table) -> Iterator[pa.RecordBatch]:
        links = region_links(_sets(unit.column("text").combine_chunks()), percent)
        ids = unit.column("id").combine_chunks()
        if links:
            yield pa.record_batch([ids.take(pa.array([x for x, _ in links])), ids.take(pa.array([y for _, y in links]))], names=["a", "b"])

    kind = rows.schema["id"].dataType.simpleString()
    return _by_unit(rows, work, f"a {kind}, b {kind}")


def _divide_units(rows: DataFrame, percent: int) -> DataFrame:
    """(id, pivot if linked to it, cell, distance to the cell's pivot) for units of documents (role 1) behind their region's pivots (role 0)."""
    t = 1 - percent / 100

    def work(unit: pa.Table) -> Iterator[pa.RecordBatch]:
        role = unit.column("role").to_numpy()
        region = _Region(_sets(unit.column("text").combine_chunks()), percent)
        docs, pivots = np.flatnonzero(role == 1), np.flatnonzero(role == 0)
        if not len(docs):
            return
        both = np.stack([region.common(p, docs) for p in pivots.tolist()])
        union = region.size[pivots][:, None] + region.size[docs] - both
        d = 1 - both / np.maximum(union, 1)
        near = 100 * both >= percent * union
        ids = unit.column("id").combine_chunks()
        for k, cell in enumerate(cells_of(d, t)):
            if not len(cell):
                continue
            rest = k == len(pivots)
            is_linked = np.zeros(len(cell), bool) if rest else near[k][cell]
            far = np.ones(len(cell)) if rest else d[k][cell]
            n = len(cell)
            to = pa.nulls(n, ids.type) if rest else pa.array([ids[int(pivots[k])].as_py()] * n, ids.type)
            columns = [pa.array([unit.column("region")[0].as_py()] * n), ids.take(pa.array(docs[cell])), to, pa.array(is_linked), pa.array(np.full(n, k, np.int32)), pa.array(far)]
            yield pa.record_batch(columns, names=["region", "id", "pivot", "linked", "cell", "d"])

    kind = rows.schema["id"].dataType.simpleString()
    return _by_unit(rows, work, f"region string, id {kind}, pivot {kind}, linked boolean, cell int, d double")


def region_sizes(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """(region, units): how many units of at most ``REGION_DOCS`` documents and about ``REGION_BYTES`` a region makes; regions of one document are left out."""
    held = members.join(sizes, "id").groupBy("region").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("bytes")).where("docs > 1")
    units = F.greatest(F.ceil(F.col("docs") / REGION_DOCS), F.ceil(F.col("bytes") / REGION_BYTES))
    return held.select("region", "docs", F.when(F.col("docs") == 2, 1).otherwise(units).cast("int").alias("units"))


def links(docs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between nodes (id, name, print, n, marked, tokens) that join all that is linked; ``docs`` is (id, print, text) of all rows."""
    members = common.written(coarse_regions(nodes, percent))
    wanted = common.written(nodes.select(F.col("id").alias("node"), "name", F.col("print").alias("mark")).join(members.select(F.col("id").alias("node")).distinct(), "node"))
    # one plan at every size: the candidates grow with the corpus
    texts = docs.join(wanted.hint("merge"), (F.col("id") == F.col("name")) & (F.col("print") == F.col("mark"))).select(F.col("node").alias("id"), "text").dropDuplicates(["id"])
    texts = common.written(texts.withColumn("size", F.octet_length("text")))
    sizes = texts.select("id", "size")
    found, round_no = None, 0

    def add(more: DataFrame) -> None:
        nonlocal found
        found = more if found is None else found.unionByName(more)

    def unit(k: Column) -> list[Column]:
        return [F.col("region"), k.cast("string").alias("unit"), F.lit(1).alias("role"), F.col("id"), F.col("text")]

    while True:
        units = common.written(region_sizes(members, sizes))
        small = members.join(units.where("units = 1"), "region").join(texts, "id")
        add(common.written(_join_units(small.select(*unit(F.lit(0))), percent)))
        large = units.where("units > 1")
        if large.isEmpty():
            return found
        members = common.written(members.join(large, "region").select("region", "id", "docs", "units"))
        salted = F.xxhash64("id", F.lit(round_no))
        order = Window.partitionBy("region").orderBy(salted, "id")
        pivots = members.withColumn("no", F.row_number().over(order)).where(F.col("no") <= PIVOTS)
        pivots = pivots.join(texts, "id").select("region", F.explode(F.sequence(F.lit(0), F.col("units") - 1)).alias("unit"), F.lit(0).alias("role"), "id", "text")
        rows = members.withColumn("unit", F.pmod(salted, F.col("units")).cast("int")).join(texts, "id").select("region", "unit", F.lit(1).alias("role"), "id", "text")
        divided = common.written(_divide_units(pivots.unionByName(rows).withColumn("unit", F.col("unit").cast("string")), percent))
        add(divided.where("linked and id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct())
        # of the linked members only those stay that an unlinked one of the cell may be within t of
        cells = divided.groupBy("region", "cell").agg(F.min(F.when(~F.col("linked"), F.col("d"))).alias("nearest")).where("nearest is not null")
        stay = divided.join(cells, ["region", "cell"]).where(~F.col("linked") | (F.col("d") >= F.col("nearest") - (1 - percent / 100) - 1e-9))
        stay = common.written(stay.select("region", "cell", "id"))
        # cells must at least halve the pairs to compare; a region that they do not divide is compared whole, by pairs of blocks
        work = stay.groupBy("region", "cell").agg(F.count(F.lit(1)).alias("n")).groupBy("region").agg(F.sum(F.col("n") * F.col("n")).alias("work"))
        work = common.written(work.join(large, "region").select("region", (F.col("work") * 2 > F.col("docs") * F.col("docs")).alias("whole")))
        block = members.join(work.where("whole"), "region").withColumn("block", F.pmod(salted, F.col("units")).cast("int"))
        other = block.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("units") - 1)))
        pair = F.concat_ws("-", F.least("block", "other").cast("string"), F.greatest("block", "other").cast("string"))
        add(common.written(_join_units(other.join(texts, "id").select(*unit(pair)), percent)))
        members = common.written(stay.join(work.where("not whole"), "region").select(F.concat_ws(".", "region", "cell").alias("region"), "id"))
        round_no += 1


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per row: id, ``n_shingles`` and ``component_id``, the smallest id reachable by links."""
    own = common.written(sketches(docs, id_col, text_col, percent))
    filled = own.where("n > 0 and id is not null")
    # a node is a set; the smallest id that has it stands for it, and further ids with the set link to that one
    first = filled.groupBy("key").agg(F.min(F.struct("id", "no")).alias("x")).select("key", F.col("x.id").alias("name"), F.col("x.no").alias("first_no"))
    placed = common.written(filled.select("key", "id", "no").join(first, "key").select("id", "no", "name", "first_no"))
    same = placed.where("id <> name").select(F.col("id").alias("a"), F.col("name").alias("b")).distinct()
    copies = common.written(placed.where("no <> first_no").select(F.col("no").alias("copy")))
    nodes = filled.join(copies, F.col("no") == F.col("copy"), "left_anti").select(F.col("no").alias("id"), F.col("id").alias("name"), "print", "n", "marked", "tokens")
    found = links(_texts(docs, id_col, text_col), nodes, percent)
    for end in ("a", "b"):
        found = found.withColumnRenamed(end, "id").join(nodes.select("id", F.col("name").alias(end)), "id").drop("id")
    groups = near_dup.components(found.select("a", "b").unionByName(same))
    groups = groups.select(F.col("id").alias("member"), "component")
    rows = own.select("id", "n").join(groups, F.col("id") == F.col("member"), "left")
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
