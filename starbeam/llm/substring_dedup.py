"""Substring deduplication over FM-indexes of content-dealt shards.

A window of 13 words goes when its word sequence also starts in a document with a smaller id; the
words it covers are removed. Words are runs between ASCII white space, held as 64-bit hashes.

An index over all documents that every document is streamed through would cost the square of the
corpus, so windows are dealt to shards by their content, as minimizers do for genome reads:

1. The minimizer of a window is the least hash of its 4-word grams. Equal windows have equal
   minimizers; consecutive windows share one, and such a run is a segment.
2. Minimizers that only one document has are dropped: their windows occur nowhere else. Counts
   are added up per task before the shuffle.
3. The remaining segments go to the shard of their minimizer, each distinct segment of a batch
   once with its smallest and largest document. Where one minimizer stands for over ``HOT``
   segments, each window is a segment of its own and goes to the shard of its whole content,
   so a passage that a third of all documents share is spread.
4. A shard sorts the suffixes of its segments by their first 13 words, keeps the Burrows-Wheeler
   transform as a wavelet matrix of packed bits with rank counts, and streams its segments, in
   blocks, through backward search: 13 steps of two ranks per window give the interval of the
   window's occurrences, and a window whose interval falls to one suffix stops early. An interval
   of full length is one run of the sorted suffixes, whose smallest document is kept with it.
5. The smallest documents return to the segments' places by a join; a window whose smallest document
   is below its own is marked.

Defined results: null text has no words; a document under 13 words loses nothing; rows without an id
are left as they are and do not count as earlier documents; rows that repeat an id are judged each
by its own text, and an equal id is not smaller; an empty table gives an empty result. Ids are integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from starbeam.llm import common
from starbeam.llm import textscan as ts

WINDOW, GRAM = 13, 4
HOT = 1 << 14
SHARD_SEGMENTS = 1 << 15
STREAM = 1 << 17

_GRAM_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def minimizers(words: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """The minimizer of the window that starts at each word (meaningful where a whole window fits)."""
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(len(words) - gram + 1, np.uint64)
        for k in range(gram):
            h += words[k : len(words) - gram + 1 + k] * _GRAM_FACTORS[k % 4] + np.uint64(k)
        h = ts.mix(h)
    width, span = window - gram + 1, 1
    while 2 * span <= width:
        h = np.minimum(h[: len(h) - span], h[span:])
        span *= 2
    return np.minimum(h[:n], h[width - span : width - span + n])


def runs(words: np.ndarray, first: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first window, number of windows, minimizer) of the segments of documents ``words[first[i]:first[i + 1]]``."""
    least = minimizers(words, window)
    n = np.diff(first)
    windows = np.maximum(n - window + 1, 0)
    doc = np.repeat(np.arange(len(n)), windows)
    at = ts.take_ranges(np.arange(len(words) + 1), first[:-1], windows)
    own = least[at] if len(at) else np.zeros(0, np.uint64)
    new = np.ones(len(at), bool)
    new[1:] = (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new)
    return doc[start], at[start], np.diff(np.append(start, len(at))), own[start]


class Wavelet:
    """Rank queries over a sequence of small integers: one bit array per level, packed, with counts per 64 bits."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        for level in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bit = ((sequence >> level) & 1).astype(bool)
            padded = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            padded[: len(bit)] = bit
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])[:-1].astype(np.int32)
            zeros = len(bit) - int(bit.sum())
            self.levels.append((level, packed, before, zeros))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])

    def position(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Where each position ends in the last level on the symbol's path; differences there count occurrences."""
        for level, packed, before, zeros in self.levels:
            one = ((symbol >> level) & 1).astype(bool)
            ones = self._ones(packed, before, position)
            position = np.where(one, zeros + ones, position - ones)
        return position

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, position: np.ndarray) -> np.ndarray:
        block = position >> 6
        mask = (np.uint64(1) << (position & 63).astype(np.uint64)) - np.uint64(1)
        return before[block] + np.bitwise_count(packed[block] & mask).astype(np.int64)


class FMIndex:
    """FM-index of a text of word numbers (0 separates segments) for patterns of up to ``window`` words."""

    def __init__(self, text: np.ndarray, window: int = WINDOW):
        n = len(text)
        rank, span = text.astype(np.int64), 1
        while 2 * span <= window:
            rank, span = self._doubled(rank, span, n), 2 * span
        key = self._paired(rank, window - span, n)
        self.suffixes = np.argsort(key, kind="stable")
        ordered = key[self.suffixes]
        self.run_starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        symbols = int(text.max(initial=0)) + 1
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        transform = text[self.suffixes - 1]
        self.wavelet = Wavelet(transform, symbols)
        self.begin = self.wavelet.position(np.arange(symbols), np.zeros(symbols, np.int64))

    @staticmethod
    def _paired(rank: np.ndarray, shift: int, n: int) -> np.ndarray:
        if not shift:
            return rank
        later = np.zeros(n, np.int64)
        later[: n - shift] = rank[shift:]
        return rank * (int(rank.max(initial=0)) + 1) + later

    @classmethod
    def _doubled(cls, rank: np.ndarray, shift: int, n: int) -> np.ndarray:
        key = cls._paired(rank, shift, n)
        order = np.argsort(key)
        ordered = key[order]
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(np.concatenate([[0], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        return out

    def intervals(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval of each row of ``patterns``; rows with fewer than two occurrences stop as soon as that is known."""
        last = patterns[:, -1]
        low, high = self.below[last], self.below[last + 1]
        on = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 2, -1, -1):
            on = on[high[on] - low[on] > 1]
            symbol = patterns[on, k]
            base = self.below[symbol] - self.begin[symbol]
            low[on] = base + self.wavelet.position(symbol, low[on])
            high[on] = base + self.wavelet.position(symbol, high[on])
        return low, high


def smallest_documents(segments: list[np.ndarray], least: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each segment (word hashes): the smallest document of each of its windows over all segments."""
    sizes = np.array([len(s) for s in segments], np.int64)
    words, number = np.unique(np.concatenate(segments), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.zeros(int(starts[-1]), np.int64)
    at = np.arange(len(number)) + np.repeat(np.arange(len(sizes)), sizes)
    text[at] = number + 1
    index = FMIndex(text, window)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    by_run = np.minimum.reduceat(least[owner[index.suffixes]], index.run_starts)
    count = sizes - window + 1
    begin = ts.take_ranges(np.arange(len(text)), starts[:-1], count)
    best = least[owner[begin]]
    for a in range(0, len(begin), STREAM):
        part = begin[a : a + STREAM]
        low, high = index.intervals(text[part[:, None] + np.arange(window)])
        several = np.flatnonzero(high - low > 1)
        run = np.searchsorted(index.run_starts, low[several], "right") - 1
        best[a + several] = by_run[run]
    return np.split(best, np.cumsum(count)[:-1])


def _words(batch: pa.RecordBatch, column: str):
    for part, data, offsets in ts.text_groups(batch, column):
        h, s, e = ts.scan_words(data, offsets[:-1], ts.NOT_SPACE)
        yield part, data, h, s, e, ts.rows_of(s, offsets)


def document_minimizers(docs: DataFrame) -> DataFrame:
    """(minimizer, id, hash): each document's distinct minimizers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, h, _, _, first in _words(batch, "text"):
                doc, _, _, least = runs(h, first)
                order = np.lexsort((least, doc))
                doc, least = doc[order], least[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (least[1:] != least[:-1])
                doc = pa.array(doc[new])
                yield pa.record_batch([pa.array(least[new].view(np.int64)), part.column("id").take(doc), part.column("hash").take(doc)], names=["minimizer", "id", "hash"])

    kind = docs.schema["id"].dataType.simpleString()
    return common.map_arrow(docs, run, f"minimizer long, id {kind}, hash int")


def segment_rows(held: DataFrame, shards: int, distinct: bool) -> DataFrame:
    """Segments of documents with ``shared`` and ``hot`` minimizers: with their text and dealt to shards
    (``distinct``: each distinct one of a batch once), or only where they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, h, s, e, first in _words(batch, "text"):
                doc, at, count, least = runs(h, first)
                shared, hot = (_member(part.column(c), doc, least) for c in ("shared", "hot"))
                alone = np.flatnonzero(shared & hot)
                n = count[alone]
                whole = np.flatnonzero(shared & ~hot)
                place = np.concatenate([at[whole], ts.take_ranges(np.arange(len(h) + 1), at[alone], n)])
                windows = np.concatenate([count[whole], np.ones(int(n.sum()), np.int64)])
                doc = np.concatenate([doc[whole], np.repeat(doc[alone], n)])
                least = np.concatenate([least[whole], np.repeat(least[alone], n)])
                if not len(place):
                    continue
                size = windows + WINDOW - 1
                with np.errstate(over="ignore"):
                    edge = np.cumsum(size) - size
                    inside = (np.arange(int(size.sum())) - np.repeat(edge, size)).astype(np.uint64)
                    flat = ts.mix(ts.take_ranges(h, place, size) + inside * np.uint64(0x9E3779B97F4A7C15))
                    own = ts.mix(np.add.reduceat(flat, edge) + size.astype(np.uint64))
                    single = np.arange(len(place)) >= len(whole)
                    shard = (ts.mix(np.where(single, own, least)) % np.uint64(shards)).astype(np.int32)
                if not distinct:
                    at = pa.array(doc)
                    columns = [part.column("id").take(at), part.column("hash").take(at), pa.array((place - first[doc]).astype(np.int32)), pa.array(shard), pa.array(own.view(np.int64))]
                    yield pa.record_batch(columns, names=["id", "hash", "place", "shard", "segment"])
                    continue
                order = np.argsort(own, kind="stable")
                heads = np.flatnonzero(np.concatenate([[True], own[order][1:] != own[order][:-1]]))
                pick = order[heads]
                value = part.column("id").to_numpy(zero_copy_only=False)[doc[order]]
                begin = s[place[pick]]
                length = e[place[pick] + size[pick] - 1] - begin
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                text = pa.Array.from_buffers(pa.binary(), len(pick), [None, pa.py_buffer(ends), pa.py_buffer(ts.take_ranges(data, begin, length).tobytes())])
                columns = [pa.array(shard[pick]), pa.array(own[pick].view(np.int64)), pa.array(np.minimum.reduceat(value, heads)), pa.array(np.maximum.reduceat(value, heads)), text]
                yield pa.record_batch(columns, names=["shard", "segment", "first_doc", "last_doc", "text"])

    kind = held.schema["id"].dataType.simpleString()
    schema = f"shard int, segment long, first_doc {kind}, last_doc {kind}, text binary" if distinct else f"id {kind}, hash int, place int, shard int, segment long"
    return common.map_arrow(held, run, schema)


def _member(lists: pa.Array, doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether each value is in its document's list (a null list is empty)."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    size = np.array([0 if n is None else n for n in pc.list_value_length(lists).to_pylist()], np.int64)
    owner = np.repeat(np.arange(len(size)), size)
    with np.errstate(over="ignore"):
        salt = np.uint64(0x9E3779B97F4A7C15)
        return np.isin(ts.mix(value + doc.astype(np.uint64) * salt), ts.mix(flat + owner.astype(np.uint64) * salt))


def search_shards(segments: DataFrame) -> DataFrame:
    """(shard, segment, firsts): the smallest document of each window of the segments that any document may lose words by."""

    def search(table: pa.Table) -> pa.Table:
        shard, segment, first, last = (table.column(c).to_numpy() for c in ("shard", "segment", "first_doc", "last_doc"))
        order = np.argsort(segment, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], segment[order][1:] != segment[order][:-1]]))
        pick = order[heads]
        least, most = np.minimum.reduceat(first[order], heads), np.maximum.reduceat(last[order], heads)
        text = table.column("text").take(pa.array(pick)).combine_chunks().cast(pa.string())
        words = []
        for _, _, h, _, _, at in _words(pa.record_batch([text], names=["text"]), "text"):
            words += np.split(h, at[1:-1])
        found = smallest_documents(words, least)
        keep = [i for i, f in enumerate(found) if f.min() < most[i]]
        return pa.table({
            "shard": pa.array(shard[pick[keep]], pa.int32()),
            "segment": pa.array(segment[pick[keep]], pa.int64()),
            "firsts": pa.array([found[i] for i in keep], pa.list_(pa.int64())),
        })

    common.ship(segments.sparkSession)
    return segments.groupBy("shard").applyInArrow(search, "shard int, segment long, firsts array<long>")


def marked_windows(known: DataFrame) -> DataFrame:
    """(id, hash, windows) with the marked window starts of the rows (id, hash, text) that have any."""
    each = document_minimizers(known)
    shared = common.written(each.groupBy("minimizer").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    total = shared.agg(F.sum("n")).first()[0] or 0
    shards = max(1, math.ceil(total / SHARD_SEGMENTS))
    lists = (
        each.join(shared, "minimizer")
        .groupBy("id", "hash")
        .agg(F.collect_list("minimizer").alias("shared"), F.collect_list(F.when(F.col("n") > HOT, F.col("minimizer"))).alias("hot"))
    )
    held = known.join(common.written(lists), ["id", "hash"]).select("id", "hash", "text", "shared", "hot")
    found = search_shards(segment_rows(held, shards, True))
    marked = segment_rows(held, shards, False).join(found, ["shard", "segment"])
    below = F.filter(F.transform("firsts", lambda f, i: F.when(f < F.col("id"), i + F.col("place"))), lambda i: i.isNotNull())
    windows = marked.select("id", "hash", below.alias("windows")).where(F.size("windows") > 0)
    return windows.groupBy("id", "hash").agg(F.flatten(F.collect_list("windows")).alias("windows"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed``, ``kept_text`` (the words that stay, joined by blanks)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("hash", F.hash("text"))
    known, unknown = rows.where("id is not null"), rows.where("id is null")
    joined = known.join(marked_windows(known), ["id", "hash"], "left").select("id", "text", "windows")
    joined = joined.unionByName(unknown.select("id", "text"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, h, s, e, first in _words(batch, "text"):
                raw = data.tobytes()
                removed, kept = [], []
                for i, windows in enumerate(part.column("windows")):
                    a, b = int(first[i]), int(first[i + 1])
                    stay = np.ones(b - a, bool)
                    if windows.is_valid:
                        edges = np.zeros(b - a + 1, np.int64)
                        at = np.unique(windows.values.to_numpy(zero_copy_only=False))
                        edges[at] += 1
                        np.subtract.at(edges, at + WINDOW, 1)
                        stay = np.cumsum(edges)[:-1] == 0
                    removed.append(int((~stay).sum()))
                    kept.append(b" ".join([raw[x:y] for x, y in zip(s[a:b][stay].tolist(), e[a:b][stay].tolist())]).decode("utf-8"))
                yield pa.record_batch([part.column("id"), pa.array(np.diff(first)), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=[id_col, "n_words", "n_removed", "kept_text"])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    return common.map_arrow(joined, run, schema)


def report(result: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns."""
    return result.select(id_col, "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
