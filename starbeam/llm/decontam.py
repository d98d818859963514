"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` turns the documents into posting blocks, one row per few thousand documents:

- ``terms``: the distinct 64-bit word hashes of the block, ascending;
- ``offsets``: where each term's postings begin;
- ``postings``: word positions inside the block, ascending per term. Documents of a block are laid
  one after another with an empty position between them, so no phrase crosses a document;
- ``doc_ids`` and ``doc_starts``: the block's documents and their first positions.

``search`` looks phrases up in every block. For each phrase (a window of a benchmark item) it
takes the list lengths of its terms, drops the phrase when a term is absent, starts from the
rarest term's postings and intersects them, offset-adjusted, with the other terms' lists from the
rarer to the commoner. With ``slop`` 0 the terms must stand at their exact offsets (a phrase match);
with a larger ``slop`` each term may stand up to so many words off (a proximity match).

The phrases travel to the blocks in broadcast blocks of at most ``PHRASES`` phrases (80 bytes
each), as many as the benchmark needs, so what is broadcast at once has a fixed bound. Nothing is
shuffled: a document's words, postings and hits stay in its block. Equal words are words with equal
64-bit hashes; a false match needs one such collision inside a phrase whose other words all agree.

Defined results: null text has no words; an item without words has no phrase; an item shorter
than the window is one phrase; equal items all count; a null document id keeps its row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from starbeam.llm import common
from starbeam.llm import textscan as ts

WINDOW = 10
PHRASES = 1 << 17
BLOCK_WORDS = 1 << 19


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Posting blocks of the lower-cased words of all documents (see the module's text)."""
    id_type = docs.schema[id_col].dataType

    def block(ids: list, counts: list[np.ndarray], hashes: list[np.ndarray]) -> pa.RecordBatch:
        n = np.concatenate(counts)
        starts = np.concatenate([[0], np.cumsum(n + 1)]).astype(np.uint32)
        words = np.concatenate(hashes)
        at = np.arange(len(words), dtype=np.uint32) + np.repeat(np.arange(len(n), dtype=np.uint32), n)
        order = np.argsort(words, kind="stable")
        words = words[order]
        first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.int64)
        binary = [starts.tobytes(), words[first].tobytes(), first.astype(np.uint32).tobytes(), at[order].tobytes()]
        column = pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type))
        return pa.record_batch([column, *(pa.array([x], pa.binary()) for x in binary)], names=["doc_ids", "doc_starts", "terms", "offsets", "postings"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, hashes, size = [], [], [], 0
        for batch in batches:
            for part, data, offsets in ts.text_groups(batch, text_col):
                h, s, _ = ts.scan_words(data, offsets[:-1], ts.ALNUM_OR_WIDE, ts.LOWER)
                ids.append(part.column(id_col))
                counts.append(np.diff(ts.rows_of(s, offsets)))
                hashes.append(h)
                size += len(h)
                if size >= block_words:
                    yield block(ids, counts, hashes)
                    ids, counts, hashes, size = [], [], [], 0
        if ids:
            yield block(ids, counts, hashes)

    schema = T.StructType([T.StructField("doc_ids", T.ArrayType(id_type)), *(T.StructField(c, T.BinaryType()) for c in ("doc_starts", "terms", "offsets", "postings"))])
    return common.map_arrow(docs.select(id_col, text_col), build, schema)


def _phrases(items: Iterator, window: int):
    """(item ids, lengths, term hashes as rows of ``window``) of the windows of an iterator of (item id, text)."""
    ids, lengths, rows = [], [], []
    for item, text in items:
        data = np.frombuffer((text or "").encode("utf-8"), np.uint8)
        h, _, _ = ts.scan_words(data, np.zeros(1, np.int64), ts.ALNUM_OR_WIDE, ts.LOWER)
        if not len(h):
            continue
        size = min(window, len(h))
        for w in {tuple(map(int, h[i : i + size])) for i in range(len(h) - size + 1)}:
            ids.append(str(item))
            lengths.append(size)
            rows.append(w + (0,) * (window - size))
    return ids, np.array(lengths, np.int64), np.array(rows, np.uint64).reshape(-1, window)


def phrase_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW, most: int = PHRASES) -> list:
    """Broadcast blocks of at most about ``most`` phrases (one item's phrases stay together)."""
    sc, out, held, size = benchmark.sparkSession.sparkContext, [], [], 0
    for row in benchmark.select(item_col, text_col).toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1] or "") // 2 + 1
        if size >= most:
            out.append(sc.broadcast(_phrases(held, window)))
            held, size = [], 0
    if held:
        out.append(sc.broadcast(_phrases(held, window)))
    return out


def _find(doc_starts, terms, offsets, postings, lengths, rows, slop):
    """(phrase, document, start) of every match of the phrases in one posting block."""
    nothing = np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(terms, rows), len(terms) - 1)
    used = np.arange(rows.shape[1]) < lengths[:, None]
    phrase = np.flatnonzero(((terms[at] == rows) | ~used).all(axis=1))
    if not len(phrase):
        return nothing, nothing, nothing
    at, used, size = at[phrase], used[phrase], lengths[phrase]
    counts = np.where(used, offsets[at + 1] - offsets[at], np.iinfo(np.int64).max)
    order = np.argsort(counts, axis=1, kind="stable")
    rare, pick = order[:, 0], np.arange(len(phrase))
    n = counts[pick, rare]
    anchor = ts.take_ranges(postings, offsets[at[pick, rare]], n).astype(np.int64)
    start, which = anchor - np.repeat(rare, n), np.repeat(pick, n)
    doc = np.searchsorted(doc_starts, anchor, "right") - 1
    keyed = (np.repeat(np.arange(len(terms), dtype=np.int64), np.diff(offsets)) << 33) + postings
    for k in range(1, rows.shape[1]):
        j = order[which, k]
        list_key = at[which, j] << 33
        low = list_key + np.maximum(start + j - slop, doc_starts[doc])
        high = list_key + np.minimum(start + j + slop, doc_starts[doc + 1] - 2)
        nearest = keyed[np.minimum(np.searchsorted(keyed, low), len(keyed) - 1)]
        ok = (size[which] <= k) | ((nearest >= low) & (nearest <= high))
        which, start, doc = which[ok], start[ok], doc[ok]
    return phrase[which], doc, np.maximum(start, doc_starts[doc])


def search(index: DataFrame, phrases: list, id_col: str = "doc_id", slop: int = 0) -> DataFrame:
    """Per document of the index: ``n_words``, ``n_hit`` (words inside a match), ``item_ids`` (items with a match, as sorted strings)."""
    id_type = index.schema["doc_ids"].dataType.elementType

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column("doc_ids").slice(r, 1).flatten()
                starts, terms, offsets, postings = (
                    np.frombuffer(batch.column(c)[r].as_buffer(), t)
                    for c, t in (("doc_starts", np.uint32), ("terms", np.uint64), ("offsets", np.uint32), ("postings", np.uint32))
                )
                starts, offsets = starts.astype(np.int64), np.append(offsets, len(postings)).astype(np.int64)
                cover, items = np.zeros(int(starts[-1]) + 1, np.int32), {}
                for part in phrases if len(terms) else []:
                    names, lengths, rows = part.value
                    if not len(lengths):
                        continue
                    phrase, doc, start = _find(starts, terms, offsets, postings, lengths, rows, slop)
                    np.add.at(cover, start, 1)
                    np.add.at(cover, np.minimum(start + lengths[phrase], starts[doc + 1] - 1), -1)
                    for d, p in set(zip(doc.tolist(), phrase.tolist())):
                        items.setdefault(d, set()).add(names[p])
                hit = np.concatenate([[0], np.cumsum(np.cumsum(cover) > 0)])
                n = np.diff(starts) - 1
                yield pa.record_batch(
                    [ids, pa.array(n), pa.array(hit[starts[1:] - 1] - hit[starts[:-1]]), pa.array([sorted(items.get(d, ())) for d in range(len(ids))], pa.list_(pa.string()))],
                    names=[id_col, "n_words", "n_hit", "item_ids"],
                )

    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType()))])
    return common.map_arrow(index, look, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, slop: int = 0, keep_index: bool = True) -> DataFrame:
    """Matches of every benchmark item in every document; the index is stored in the shared folder first unless ``keep_index`` is off."""
    index = build_index(docs, id_col, text_col)
    if keep_index:
        index = common.stored(index)
    return search(index, phrase_blocks(benchmark, window=window), id_col, slop)


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows without a match, with all their columns; rows without an id or with a repeated one are told apart."""
    rows, key = common.told_apart(docs, id_col, text_col)
    hit = common.written(decontaminate(rows, benchmark, key, text_col, window).where("n_hit > 0").select(F.col(key).alias("hit_id")).distinct())
    return rows.join(hit, rows[key] == hit["hit_id"], "left_anti").select(*[rows[c] for c in docs.columns])


def report(matches: DataFrame) -> DataFrame:
    """The digest columns: number of items, hash of their comma-joined ids, contaminated or not."""
    return matches.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
