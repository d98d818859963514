"""Near-duplicates by BagMinHash over five-word shingles, banded and verified.

A document is the multiset of its five-word shingles (lower-cased words of ASCII letters, digits
and anything beyond ASCII); a shorter document is one shingle of all its words. Similarity is the
weighted Jaccard similarity of multisets, sum of minima over sum of maxima, and the threshold 0.8.

1. Signature. The weight axis of every shingle is cut at 1, 2, 4, 8 ...; each piece [a, b) carries a
   Poisson process of rate b - a. A point belongs to the unit cell of the axis that its hash picks, and
   counts for a document if that cell lies below the shingle's weight there, so pieces wholly
   below the weight keep all their points and the last one is thinned down the hierarchy. Each
   point falls to one of ``SLOTS`` slots; a slot keeps its earliest point. Two documents agree in a
   slot with probability equal to their weighted Jaccard similarity, without bias. Points are
   produced in order of time for all shingles of a few megabytes at once, and a process stops when
   its next point is later than the latest slot of its document, so most give one point only.
2. Bands of ``ROWS`` slots are candidates' keys: at similarity 0.8 a pair shares one of the 20
   bands with probability over 0.9999. Documents with equal multisets are one text class and
   only its smallest id takes part from here on.
3. Verification. In every bucket all members are compared with the bucket's smallest id, on the
   whole texts, so a bucket gives one pair per member, not all pairs. Members that share a bucket
   share its smallest id, so documents are then gathered by that id; where all of such a group
   link to it, as large groups of copies do, all is known. The other groups are dealt to pairs of blocks of at most ``BLOCK_DOCS`` documents and
   ``BLOCK_BYTES`` bytes; a task computes the exact overlaps of two blocks as one matrix product over
   the shingles that several of their documents have, and returns only links that join
   what was apart. No link between components is lost, and no list of all pairs is made.
4. Components come from alternating large-star and small-star steps as joins and aggregates.

Nothing is collected; a hot bucket or class is aggregated per task before the shuffle and joined
with skew handling. Steps are checkpointed in the shared folder.

Defined results: null or empty text (or one without words) has no shingles; all such rows are one
text class, without links to others, or with ``wordless_apart`` (the query and the pipeline) one
text class for each distinct text, null as empty; a null id is left out of classes and returned as its own
with null columns; rows that repeat an id count as one document (and are each returned); an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starbeam.llm import common
from starbeam.llm import textscan as ts

SHINGLE, THRESHOLD = 5, 0.8
SLOTS, ROWS = 80, 4
CHUNK = 1 << 20
BLOCK_DOCS, BLOCK_BYTES, COLUMNS = 512, 8 << 20, 4096
#: Most documents of one slice (the upper bits of a sort key) and bits of a shingle's id.
DOC_BITS, ID_BITS = 12, 52

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(words: np.ndarray, first: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle id, count), sorted, for word hashes of documents ``words[first[i]:first[i + 1]]`` (at most 4096)."""
    n = np.diff(first)
    own = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    doc = np.repeat(np.arange(len(n)), own)
    start = ts.take_ranges(np.arange(len(words) + 1), first[:-1], own)
    with np.errstate(over="ignore"):
        h = np.zeros(len(start), np.uint64)
        for k in range(size):
            there = start + k < first[doc + 1]
            h += np.where(there, words[np.minimum(start + k, len(words) - 1)] if len(words) else 0, np.uint64(k + 1)) * _FACTORS[k % 5] + np.uint64(k // 5)
        h = ts.mix(h)
    key = np.sort((doc.astype(np.uint64) << np.uint64(ID_BITS)) | (h >> np.uint64(64 - ID_BITS)))
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(at, len(key)))
    key = key[at]
    return (key >> np.uint64(ID_BITS)).astype(np.int64), key & np.uint64((1 << ID_BITS) - 1), count


def signatures(doc: np.ndarray, item: np.ndarray, weight: np.ndarray, docs: int, slots: int = SLOTS) -> np.ndarray:
    """BagMinHash signatures, one row of ``slots`` 64-bit values per document (time bits of the earliest points)."""
    sig = np.full(docs * slots, np.inf)
    with np.errstate(over="ignore"):
        low, high = 0, 1
        pieces = []
        while True:
            part = np.flatnonzero(weight > low)
            if not len(part):
                break
            pieces.append((part, low, high))
            low, high = high, 2 * high
        for part, low, high in pieces:
            for a in range(0, len(part), CHUNK):
                p = part[a : a + CHUNK]
                d, w = doc[p], weight[p]
                seed = ts.mix(item[p] * np.uint64(0x9FB21C651E98DF25) + np.uint64(high))
                time, step = np.zeros(len(p)), 0
                while len(p):
                    step += 1
                    x = ts.mix(seed + np.uint64(step) * np.uint64(0x9E3779B97F4A7C15))
                    time = time - np.log(((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52) / (high - low)
                    y = ts.mix(x ^ np.uint64(0x5851F42D4C957F2D))
                    counts = np.ones(len(p), bool) if high - low == 1 else low + ((y >> np.uint64(32)) % np.uint64(high - low)).astype(np.int64) < w
                    slot = d * slots + (y & np.uint64(0xFFFFFFFF)).astype(np.int64) % slots
                    better = np.flatnonzero(counts & (time < sig[slot]))
                    np.minimum.at(sig, slot[better], time[better])
                    on = np.flatnonzero(time < sig.reshape(docs, slots).max(axis=1)[d])
                    if len(on) < len(p):
                        p, d, w, seed, time = p[on], d[on], w[on], seed[on], time[on]
    return sig.view(np.uint64).reshape(docs, slots)


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` slots; the band's number is part of it."""
    docs, slots = sig.shape
    with np.errstate(over="ignore"):
        out = np.zeros((docs, slots // rows), np.uint64)
        for k in range(rows):
            out = ts.mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + sig[:, k::rows][:, : slots // rows] + np.uint64(k))
        return ts.mix(out + np.arange(slots // rows, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _slices(batch: pa.RecordBatch, column: str):
    for i in range(0, batch.num_rows, 1 << DOC_BITS):
        yield from ts.text_groups(batch.slice(i, 1 << DOC_BITS), column)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", wordless_apart: bool = False) -> DataFrame:
    """(id, key, bands): a 128-bit key of the shingle multiset and the band keys (none without shingles).

    With ``wordless_apart`` a text without shingles has a key of its bytes instead of the common one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in _slices(batch, text_col):
                h, s, _ = ts.scan_words(data, offsets[:-1], ts.ALNUM_OR_WIDE, ts.LOWER)
                first = ts.rows_of(s, offsets)
                doc, item, weight = shingles(h, first)
                n = part.num_rows
                filled, at = np.unique(doc, return_index=True)
                key, bands = np.zeros((n, 2), np.uint64), np.zeros((0, SLOTS // ROWS), np.uint64)
                if len(filled):
                    dense = np.searchsorted(filled, doc)
                    with np.errstate(over="ignore"):
                        both = item * np.uint64(0xD6E8FEB86659FD93) + weight.astype(np.uint64)
                        for k, salt in enumerate((0xA0761D6478BD642F, 0xE7037ED1A0B428DB)):
                            key[filled, k] = np.add.reduceat(ts.mix(both ^ np.uint64(salt)), at)
                    bands = band_keys(signatures(dense, item, weight, len(filled)))
                if wordless_apart:
                    for i in np.setdiff1d(np.arange(n), filled).tolist():
                        key[i] = np.frombuffer(hashlib.blake2b(data[offsets[i] : offsets[i + 1]].tobytes(), digest_size=16).digest(), np.uint64)
                size = np.zeros(n, np.int64)
                size[filled] = SLOTS // ROWS
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                keys = pa.Array.from_buffers(pa.binary(16), n, [None, pa.py_buffer(np.ascontiguousarray(key))]).cast(pa.binary())
                yield pa.record_batch(
                    [part.column("id"), keys, pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.reshape(-1).view(np.int64)))], names=["id", "key", "bands"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return common.map_arrow(docs.select(F.col(id_col).alias("id"), text_col).where("id is not null"), run, f"id {kind}, key binary, bands array<long>")


def similarity(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted ids, counts)."""
    _, i, j = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(left[1][i], right[1][j]).sum())
    total = int(left[1].sum() + right[1].sum()) - both
    return both / total if total else 1.0


def _multisets(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, data, offsets in _slices(batch, column):
        h, s, _ = ts.scan_words(data, offsets[:-1], ts.ALNUM_OR_WIDE, ts.LOWER)
        doc, item, weight = shingles(h, ts.rows_of(s, offsets))
        edge = np.searchsorted(doc, np.arange(len(offsets)))
        for i in range(len(offsets) - 1):
            yield item[edge[i] : edge[i + 1]], weight[edge[i] : edge[i + 1]]


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (``a``, ``b``) whose whole texts reach the threshold; ``texts`` is (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [similarity(x, y) >= threshold for x, y in zip(_multisets(batch, "a_text"), _multisets(batch, "b_text"))]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    held = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("a_text")), "a")
    held = held.join(texts.select(F.col("id").alias("b"), F.col("text").alias("b_text")), "b")
    kind = pairs.schema["a"].dataType.simpleString()
    return common.map_arrow(held.select("a", "b", "a_text", "b_text"), run, f"a {kind}, b {kind}").distinct()


def compared(dealt: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links (``a``, ``b``) that join different components, from the exact comparison of pairs of blocks: rows of
    (first, left, right, block, id, component, text) with one pair of blocks per (first, left, right)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, part, block = (table.column(c).to_numpy() for c in ("id", "component", "block"))
        batch = pa.record_batch([table.column("text").combine_chunks()], names=["text"])
        sets = list(_multisets(batch, "text"))
        total = np.array([w.sum() for _, w in sets], np.int64)
        doc = np.repeat(np.arange(len(sets)), total)
        weight = np.concatenate([w for _, w in sets])
        item = np.repeat(np.concatenate([i for i, _ in sets]), weight)
        nth = np.arange(len(item)) - np.repeat(np.cumsum(weight) - weight, weight)
        with np.errstate(over="ignore"):
            _, column, count = np.unique(ts.mix(item + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
        several = count[column] > 1
        doc, column = doc[several], (np.cumsum(count > 1) - 1)[column[several]]
        order = np.argsort(column, kind="stable")
        doc, column = doc[order], column[order]
        overlap = np.zeros((len(ids), len(ids)), np.float32)
        for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            own = slice(*np.searchsorted(column, [a, a + COLUMNS]))
            matrix = np.zeros((len(ids), COLUMNS), np.float32)
            matrix[doc[own], column[own] - a] = 1.0
            overlap += matrix @ matrix.T
        near = overlap >= threshold * (total[:, None] + total - overlap) - 1e-6
        near &= (part[:, None] != part) & np.tri(len(ids), k=-1, dtype=bool)
        if len(np.unique(block)) > 1:
            near &= block[:, None] != block
        parent = {p: p for p in part.tolist()}

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        for i, j in np.argwhere(near).tolist():
            x, y = root(part[i].item()), root(part[j].item())
            if x != y and similarity(sets[i], sets[j]) >= threshold:
                parent[x] = y
                out.append((ids[i], ids[j]))
        return pa.table({c: pa.array([o[k] for o in out], table.schema.field("id").type) for k, c in enumerate("ab")})

    common.ship(dealt.sparkSession)
    kind = dealt.schema["id"].dataType.simpleString()
    return dealt.groupBy("first", "left", "right").applyInArrow(run, f"a {kind}, b {kind}")


def _fingerprint(links: DataFrame) -> tuple:
    """Number of the distinct rows and two sums of their hashes: equal for equal sets."""
    sums = [F.sum(F.xxhash64(F.lit(salt), "u", "v").cast("decimal(38,0)")) for salt in (1, 2)]
    return tuple(links.agg(F.count(F.lit(1)), *sums).first())


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(id, component): the smallest id of each connected component of edges (``a``, ``b``), for ids that have an edge."""
    links = common.stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _fingerprint(links)
    for _ in range(limit):
        # large star: the larger neighbours of a node link to the smallest id around it
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: a node and its smaller neighbours link to the smallest of these
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n")
        joined = large.join(least, F.col("u") == F.col("n"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        links, before = common.stored(small), state
        state = _fingerprint(links)
        if state == before:
            break
    else:
        raise RuntimeError(f"components not settled after {limit} rounds")
    stars = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())


def link_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, wordless_apart: bool = False) -> tuple[DataFrame, DataFrame]:
    """((id, text_class) of all documents, verified links (a, b) between text classes that settle all components)."""
    own = common.stored(sketches(docs, id_col, text_col, wordless_apart))
    classes = own.groupBy("key").agg(F.min("id").alias("text_class"))
    membership = own.select("id", "key").distinct().join(classes, "key").groupBy("id").agg(F.min("text_class").alias("text_class"))
    heads = own.join(classes, (own["key"] == classes["key"]) & (F.col("id") == F.col("text_class"))).select("id", F.explode("bands").alias("band"))
    members = heads.distinct()
    sizes = members.groupBy("band").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = common.stored(members.join(sizes.select("band", "first"), "band"))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    if shared.isEmpty():
        return membership, shared.select(F.col("id").alias("a"), F.col("id").alias("b"))
    texts = common.stored(texts.join(shared.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"]))

    tried = shared.where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b")).distinct()
    links = common.stored(verified(tried, texts, threshold))
    groups = shared.select("first", "id").distinct()
    groups = groups.join(links, (groups["id"] == links["a"]) & (groups["first"] == links["b"]), "left")
    joined = F.col("a").isNotNull() | (F.col("id") == F.col("first"))
    groups = groups.select("first", "id", F.when(joined, F.col("first")).otherwise(F.col("id")).alias("component"))
    groups = groups.join(texts.select("id", F.octet_length("text").alias("size")), "id")
    sizes = groups.groupBy("first").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.min("component").alias("low"), F.max("component").alias("high"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    unsettled = sizes.where("n > 2 and low <> high").select("first", blocks.alias("blocks"))
    dealt = groups.join(unsettled, "first").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.select("first", "id", "component", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("first", "id", "component", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    more = compared(dealt.join(texts, "id"), threshold)
    return membership, common.stored(links.unionByName(more).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, wordless_apart: bool = False) -> DataFrame:
    """Per row: id, ``text_class`` (smallest id with the same shingles), ``class_id`` (smallest id of its near-duplicate
    class), ``class_size`` (documents in it), ``n_links`` (verified links of its text class), ``kept`` (is the class id)."""
    membership, links = link_classes(docs, id_col, text_col, threshold, wordless_apart)
    ends = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id")))
    degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    heads = components(links).withColumnRenamed("component", "class_id").join(degree, "id").withColumnRenamed("id", "text_class")
    placed = membership.join(heads, "text_class", "left").withColumn("class_id", F.coalesce("class_id", "text_class"))
    sizes = placed.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size"))
    result = placed.join(sizes, "class_id").withColumnRenamed("id", "placed_id")
    rows = docs.select(id_col).join(result, F.col(id_col) == F.col("placed_id"), "left")
    return rows.select(
        id_col, "text_class", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"), (F.col(id_col) == F.col("class_id")).alias("kept")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, wordless_apart: bool = False) -> DataFrame:
    """The rows that stay, one row of each class (that of the smallest id), with all their columns; rows without an id or with a repeated one are told apart."""
    rows, key = common.told_apart(docs, id_col, text_col)
    gone = common.written(near_duplicates(rows, key, text_col, threshold, wordless_apart).where("not kept").select(F.col(key).alias("gone_id")).distinct())
    return rows.join(gone, rows[key] == gone["gone_id"], "left_anti").select(*[rows[c] for c in docs.columns])
