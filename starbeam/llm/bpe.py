"""Byte-level BPE encoding and decoding in numpy matrices inside Spark tasks.

A task takes a few megabytes of text at once:

1. Pre-tokens: the pattern of the rank file is applied through character classes (letter, number,
   white space, other) of all code points at once; every rule of the pattern is a rule about class
   changes (see ``pretoken_starts``).
2. Each distinct pre-token is looked up in the worker's cache; the rest are first looked up whole
   among the ranks and otherwise merged in matrices: rows of similar length form one padded matrix
   of token ids, every row merges its leftmost pair of minimum rank each round (pair ranks come
   from a hash table), the row is compacted, and rows without a mergeable pair leave the matrix.
   A pre-token over ``LONGEST_ROW`` bytes is merged with a heap over a linked list instead, in
   n log n steps, since one merge a round would cost a square of its length.
3. Ids are gathered per document; decoding gathers the bytes of each id.

Defined results: null counts as empty text (no ids); special strings are ordinary text; repeated
rows each give a row; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from starbeam.llm import common
from starbeam.llm import textscan as ts

CACHE = 1 << 18
LONGEST_ROW = 128
WIDTHS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, LONGEST_ROW)
NO_RANK = np.int32(np.iinfo(np.int32).max)

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0


def character_classes() -> np.ndarray:
    """Class of each code point as the pattern's ``\\p{L}``, ``\\p{N}`` and ``\\s`` define it."""
    import regex

    points = np.arange(0x110000)
    valid = points[(points < 0xD800) | (points > 0xDFFF)]
    text = valid.astype("<u4").tobytes().decode("utf-32-le")
    out = np.zeros(0x110000, np.uint8)
    for pattern, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, text):
            out[valid[m.start() : m.end()]] = value
    return out


def pretoken_starts(points: np.ndarray, kind: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Positions where a pre-token starts, for code points of class ``kind``; ``rows`` are the rows' first positions.

    A run of letters, of numbers or of other characters is a pre-token and takes one blank before it along;
    an apostrophe that starts a pre-token is cut after ``'s 't 'm 'd 're 've 'll``; of white space before other
    text the last character stands apart (and is taken along if it is a blank); white space at the end of a
    text stays whole.
    """
    n = len(points)
    start = np.ones(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    row = np.zeros(n + 1, bool)
    row[rows] = True
    row[n] = True
    start |= row
    gap = np.flatnonzero((kind == SPACE) & start[1:] & ~row[1:])
    start[gap] = True
    start[gap[points[gap] == 0x20] + 1] = False
    mark = np.flatnonzero((points == 0x27) & start[:n])
    if len(mark):
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        one = np.where(row[mark + 1], 0, padded[mark + 1])
        two = np.where(row[np.minimum(mark + 2, n)], 0, padded[mark + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        start[mark[short | long] + 1] = False
        start[mark[short] + 2] = True
        start[mark[long] + 2] = False
        start[mark[long] + 3] = True
    return np.flatnonzero(start[:n])


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Merger:
    """Merges pre-tokens by the ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.pairs = ts.HashTable(np.array(keys, np.uint64), np.array(values, np.int32))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        known = (left >= 0) & (right >= 0)
        out = np.full(left.shape, NO_RANK, np.int32)
        rank = self.pairs.get((left[known].astype(np.uint64) << np.uint64(32)) | right[known].astype(np.uint64))
        out[known] = np.where(rank < 0, NO_RANK, rank)
        return out

    def matrix(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all pieces one after another, number of each) for pieces of at most ``width`` bytes."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < size[:, None]] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        final = np.full((len(pieces), width), -1, np.int32)
        alive = np.arange(len(pieces))
        rank = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        while len(alive):
            best = rank.min(axis=1, initial=NO_RANK)
            done = best == NO_RANK
            if done.any():
                final[alive[done], : ids.shape[1]] = ids[done]
                alive, ids, rank = alive[~done], ids[~done], rank[~done]
                if not len(alive):
                    break
            at = rank.argmin(axis=1)
            r = np.arange(len(alive))
            ids[r, at] = rank[r, at]
            last = ids.shape[1] - 1
            ids = np.take_along_axis(ids, np.arange(last) + (np.arange(last) > at[:, None]), axis=1)
            between = np.arange(max(0, last - 1))
            rank = np.take_along_axis(rank, between + (between >= at[:, None]), axis=1)
            for j, ok in ((at - 1, at >= 1), (at, at < last - 1)):
                rank[r[ok], j[ok]] = self.pair_ranks(ids[r[ok], j[ok]], ids[r[ok], j[ok] + 1])
        return final[final >= 0], (final >= 0).sum(axis=1)

    def heap(self, piece: bytes) -> np.ndarray:
        """Token ids of one long piece."""
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        lookup = self._pair_dict()
        queue = [(lookup[p], i, p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in lookup]
        heapq.heapify(queue)
        while queue:
            rank, i, pair = heapq.heappop(queue)
            j = following[i]
            if ids[i] != pair[0] or j >= n or ids[j] != pair[1]:
                continue
            ids[i], ids[j] = rank, -1
            following[i] = k = following[j]
            if k < n:
                before[k] = i
                if (p := (rank, ids[k])) in lookup:
                    heapq.heappush(queue, (lookup[p], i, p))
            if (h := before[i]) >= 0 and (p := (ids[h], rank)) in lookup:
                heapq.heappush(queue, (lookup[p], h, p))
        return np.array([x for x in ids if x >= 0], np.int32)

    def _pair_dict(self) -> dict[tuple[int, int], int]:
        if not hasattr(self, "_dict"):
            held = np.flatnonzero(self.pairs.values >= 0)
            keys = self.pairs.keys[held]
            pairs = zip((keys >> np.uint64(32)).tolist(), (keys & np.uint64(0xFFFFFFFF)).tolist())
            self._dict = dict(zip(pairs, self.pairs.values[held].tolist()))
        return self._dict

    def encode(self, pieces: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
        """The pieces again in groups, with their ids one after another and the number of ids of each."""
        whole = [p for p in pieces if p in self.ranks]
        if whole:
            yield whole, np.fromiter((self.ranks[p] for p in whole), np.int32, len(whole)), np.ones(len(whole), np.int64)
        bucket: dict[int, list[bytes]] = {}
        for p in pieces:
            if p in self.ranks:
                continue
            if len(p) > LONGEST_ROW:
                ids = self.heap(p)
                yield [p], ids, np.array([len(ids)])
            else:
                bucket.setdefault(WIDTHS[bisect.bisect_left(WIDTHS, len(p))], []).append(p)
        for width, members in bucket.items():
            for a in range(0, len(members), 1 << 14):
                part = members[a : a + (1 << 14)]
                yield part, *self.matrix(part, width)


class Encoder:
    """Encodes whole slices of texts; keeps the ids of pre-tokens seen so far (at most about ``cache`` of them)."""

    def __init__(self, ranks: dict[bytes, int], cache: int = CACHE):
        self.merger, self.cache, self.kinds = Merger(ranks), cache, character_classes()
        by_id = sorted((i, t) for t, i in ranks.items())
        self.size = np.zeros(by_id[-1][0] + 1, np.int64)
        for i, t in by_id:
            self.size[i] = len(t)
        self.begin = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.bytes = np.frombuffer(b"".join(t for _, t in by_id), np.uint8)
        self._reset()

    def _reset(self):
        self.place: dict[bytes, int] = {}
        self.ids, self.at, self.used, self.count = np.zeros(1 << 16, np.int32), np.zeros((1 << 16) + 1, np.int64), 0, 0

    def _add(self, pieces: list[bytes]) -> None:
        for part, ids, sizes in self.merger.encode(pieces):
            need, more = self.used + len(ids), self.count + len(part)
            if need > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(2 * need - len(self.ids), np.int32)])
            if more >= len(self.at):
                self.at = np.concatenate([self.at, np.zeros(2 * more + 1 - len(self.at), np.int64)])
            self.ids[self.used : need] = ids
            self.at[self.count + 1 : more + 1] = self.used + np.cumsum(sizes)
            self.place.update(zip(part, range(self.count, more)))
            self.used, self.count = need, more

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, row offsets into ids) of the texts ``data[offsets[i]:offsets[i + 1]]``."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        rows = np.searchsorted(place, offsets)
        first = pretoken_starts(points, self.kinds[points], rows[:-1])
        starts = place[first]
        ends = np.append(starts[1:], len(data))
        h = block_hashes(data, starts, ends)
        _, example, where = np.unique(h, return_index=True, return_inverse=True)
        pieces = [raw[a:b] for a, b in zip(starts[example].tolist(), ends[example].tolist())]
        if self.count > self.cache:
            self._reset()
        new = [p for p in pieces if p not in self.place]
        if new:
            self._add(new)
        slot = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))[where]
        size = self.at[slot + 1] - self.at[slot]
        sums = np.concatenate([[0], np.cumsum(size)])
        return ts.take_ranges(self.ids, self.at[slot], size), sums[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray) -> bytes:
        return ts.take_ranges(self.bytes, self.begin[ids], self.size[ids]).tobytes()


def block_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``range_hashes`` of adjoining ranges, block by block to stay in the processor's cache."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + ts.BLOCK, "right")))
        a = starts[i]
        out[i:j] = ts.range_hashes(data[a : ends[j - 1]], starts[i:j] - a, ends[i:j] - a)
        i = j
    return out


def encode_texts(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", cache: int = CACHE, keep_ids: bool = True) -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids`` (if kept), ``ids_sha256`` (little-endian 32-bit ids), ``decoded_sha256`` (bytes decoded from the ids)."""
    sent = docs.sparkSession.sparkContext.broadcast(common.model_file(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(read_ranks(sent.value), cache)
            for part, data, offsets in ts.text_groups(batch, text_col, 1 << 20):
                ids, row = encoder.encode(data, offsets)
                digests, back = [], []
                for a, b in zip(row[:-1].tolist(), row[1:].tolist()):
                    own = ids[a:b]
                    digests.append(common.sha256_hex(own.astype("<u4").tobytes()))
                    back.append(hashlib.sha256(encoder.decode(own)).hexdigest())
                columns = [part.column(id_col), pa.array(np.diff(row)), pa.array(digests), pa.array(back)]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(row, pa.int32()), pa.array(ids, pa.int32())))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)

    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    return common.map_arrow(docs.select(id_col, text_col), run, T.StructType(fields))
