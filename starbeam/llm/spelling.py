"""Spelling variants: words one edit apart, found by banded edit rows over sorted word lists.

1. Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased. Runs are counted per batch in the
   tasks, so the shuffle carries a word and a count, never an occurrence. The vocabulary
   is the words of at least ``shortest`` letters and ``least`` occurrences.
2. Lists. One edit leaves the first or the second half of a word as it is. Of two words one edit apart
   whose shorter one has m letters, the first ``m // 2`` or the last ``m // 2`` letters agree, so a word
   of L letters goes to the lists (m, first half) and (m, second half) for m = L and m = L - 1, the
   latter kind written backwards so that its known half comes first. A list of more
   than ``MOST`` words is dealt on by the same rule: of the rest of the word the first or the last half is
   known too, until no list is longer (or nothing is left to know, which bounds it by the alphabet).
3. Search. Each list is sorted. All its words walk down it together: a state is a word, a range of the list
   that shares a prefix, and the band of three cells of the edit matrix's row for that prefix. A range
   falls apart where the adjacent common prefixes (LCP) end, its row is computed once for
   all words in it, and a range whose row exceeds one edit everywhere is skipped.
4. The form of a word is its near word with most occurrences (ties: the smallest) if that has at least
   ``ratio`` times the word's; roots follow forms to the last one by pointer doubling.

``slips`` deletes one letter of some runs before they are counted, a test of the grouping: h is the crc32 of
``<id>:<lower-cased run>``, and where ``slips`` divides h the letter at h mod length goes.

Defined results: null text has no words; a null id is written as nothing in front of the colon; rows that
repeat are counted each; an empty table or one without frequent words gives no rows; further columns are
ignored; runs of any length are counted and compared whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starbeam.llm import common
from starbeam.llm import textscan as ts

SHORTEST, LEAST, RATIO, SLIPS = 6, 5, 5, 199
MOST = 4096
#: States of the search held at once, and bytes of words.
STATES, WORD_BYTES = 1 << 18, 4 << 20
_LETTER = ts.byte_table(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ ((t & np.uint32(1)) * np.uint32(0xEDB88320))
    return t


_CRC = _crc_table()


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) in bytes of the maximal runs of letters; U+00C0 to U+00FF are 0xC3 and a continuation byte."""
    inside = _LETTER[data] | (data == 0xC3)
    inside[1:] |= (data[1:] & 0xC0 == 0x80) & (data[:-1] == 0xC3)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.concatenate([[False], inside]), np.concatenate([inside, [False]])
    return np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge))


def crc32_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray, long: int = 64) -> np.ndarray:
    """zlib's crc32 of each byte range, going on from the crc of what stands before it."""
    crc = seeds.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    on = np.flatnonzero(size <= long)
    for k in range(long):
        on = on[size[on] > k]
        if not len(on):
            break
        own = crc[on]
        crc[on] = _CRC[(own ^ data[starts[on] + k]) & np.uint32(0xFF)] ^ (own >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > long).tolist():
        crc[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(seeds[i]))
    return crc


def _slice_counts(ids: list, data: np.ndarray, offsets: np.ndarray, shortest: int, slips: int) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    """(counts, words, words that lost a letter) of a slice of texts."""
    data = ts.LOWER[data]
    starts, ends = runs(data, offsets)
    leads = np.concatenate([[0], np.cumsum(data == 0xC3)])
    size = ends - starts - (leads[ends] - leads[starts])
    keep = size >= shortest
    starts, ends, size = starts[keep], ends[keep], size[keep]
    slipped: list[bytes] = []
    if slips:
        seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        h = crc32_of(data, starts, ends, seeds[np.searchsorted(offsets, starts, "right") - 1])
        hit = h % np.uint32(slips) == 0
        for i in np.flatnonzero(hit & (size > shortest)).tolist():
            word = data[starts[i] : ends[i]].tobytes().decode("utf-8")
            at = int(h[i]) % len(word)
            slipped.append((word[:at] + word[at + 1 :]).encode("utf-8"))
        starts, ends = starts[~hit], ends[~hit]
    _, first, counts = np.unique(ts.range_hashes(data, starts, ends), return_index=True, return_counts=True)
    words = [data[a:b].tobytes() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    return counts, words, slipped


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, slips: int = 0) -> DataFrame:
    """(word, n): occurrences of every word of at least ``shortest`` letters over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        held = 0

        def flushed() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for part, data, offsets in ts.text_groups(batch, text_col):
                counts, words, slipped = _slice_counts(part.column(id_col).to_pylist(), data, offsets, shortest, slips)
                for word, n in zip(words, counts.tolist()):
                    seen[word] = seen.get(word, 0) + n
                for word in slipped:
                    seen[word] = seen.get(word, 0) + 1
                held += sum(map(len, words)) + sum(map(len, slipped))
                if held > 8 * WORD_BYTES:
                    yield flushed()
                    seen, held = {}, 0
        if seen:
            yield flushed()

    return common.map_arrow(docs.select(id_col, text_col), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def near_in_lists(words: np.ndarray, size: np.ndarray, group: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), both ways, of words one edit apart within their lists.

    ``words`` is a matrix of letters, a row a word, sorted by (group, word); ``known`` letters at its
    beginning agree within a group.
    """
    n, width = words.shape
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letters = np.zeros((n, width + 2), np.int16)
    letters[:, :width] = words
    letters[np.arange(width + 2) >= size[:, None]] = -1
    same = letters[1:, :width] == letters[:-1, :width]
    same &= letters[1:, :width] >= 0
    lcp = np.zeros(n + 1, np.int64)
    lcp[1:n] = np.where(same.all(axis=1), width, same.argmin(axis=1))
    lcp[1:n][group[1:] != group[:-1]] = -1
    lcp[0] = lcp[n] = -1
    edges = np.flatnonzero(lcp < 0)
    home = np.searchsorted(edges, np.arange(n), "right") - 1
    alone = edges[home + 1] - edges[home] < 2
    out_i, out_j = [], []
    for a in range(0, n, STATES // 64):
        q = np.flatnonzero(~alone[a : a + STATES // 64]) + a
        low, high, depth = edges[home[q]], edges[home[q] + 1], known[q].astype(np.int64)
        band = np.stack([np.ones(len(q), np.int8), np.zeros(len(q), np.int8), np.ones(len(q), np.int8)])
        pending = [(q, low, high, depth, band)]
        while pending:
            q, low, high, depth, band = pending.pop()
            if len(q) > STATES:
                half = len(q) // 2
                pending.append((q[half:], low[half:], high[half:], depth[half:], band[:, half:]))
                pending.append((q[:half], low[:half], high[:half], depth[:half], band[:, :half]))
                continue
            # words that end here are the first of their range
            ended = size[low] == depth
            gap = size[q] - depth
            last = np.where(gap == -1, band[0], np.where(gap == 0, band[1], np.where(gap == 1, band[2], 2)))
            hit = ended & (last == 1)
            out_i.append(q[hit])
            out_j.append(low[hit])
            low = low + ended
            on = np.flatnonzero(low < high)
            if not len(on):
                continue
            q, low, high, depth, band = q[on], low[on], high[on], depth[on], band[:, on]
            # children of a range: cut where adjacent words share no more than the prefix
            cuts, at = _cuts(lcp, low, high, depth)
            parts = np.diff(at) + 1
            who = np.repeat(np.arange(len(q)), parts)
            start = np.zeros(len(who), np.int64)
            first = np.cumsum(parts) - parts
            rest = np.ones(len(who), bool)
            rest[first] = False
            start[first], start[rest] = low, cuts
            stop = np.empty(len(who), np.int64)
            stop[:-1] = start[1:]
            stop[np.cumsum(parts) - 1] = high
            q, depth, old = q[who], depth[who], band[:, who]
            x = letters[start, depth]
            over = letters.shape[1] - 1
            wrong = [(letters[q, np.minimum(np.maximum(depth + k, 0), over)] != x) | (depth + k < 0) for k in (-1, 0, 1)]
            new = np.empty_like(old)
            new[0] = np.minimum(old[1] + 1, old[0] + wrong[0])
            new[1] = np.minimum(np.minimum(old[1] + wrong[1], old[2] + 1), new[0] + 1)
            new[2] = np.minimum(old[2] + wrong[2], new[1] + 1)
            np.minimum(new, 2, out=new)
            on = np.flatnonzero((new.min(axis=0) < 2) & (depth < size[q] + 1))
            if len(on):
                pending.append((q[on], start[on], stop[on], depth[on] + 1, new[:, on]))
    return np.concatenate(out_i), np.concatenate(out_j)


def _cuts(lcp: np.ndarray, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions p of (low, high) with lcp[p] == depth, range after range; where each range's begin)."""
    ranges = np.unique(np.stack([low, high, depth], axis=1), axis=0, return_inverse=True)
    (low, high, depth), which = ranges[0].T, ranges[1].reshape(-1)
    inner = high - low - 1
    places = ts.take_ranges(np.arange(len(lcp)), low + 1, inner)
    owner = np.repeat(np.arange(len(low)), inner)
    hit = lcp[places] <= depth[owner]
    cuts, count = places[hit], np.bincount(owner[hit], minlength=len(low))
    begin = np.cumsum(count) - count
    flat = ts.take_ranges(cuts, begin[which], count[which])
    return flat, np.concatenate([[0], np.cumsum(count[which])])


def _lists(words: DataFrame) -> DataFrame:
    """(m, list, known, w, word, n): the two kinds of lists for m = L and m = L - 1, ``w`` with its known half first."""
    size = F.length("word")
    each = words.withColumn("m", F.explode(F.array(size, size - 1))).where("m > 0").withColumn("known", F.expr("m div 2"))
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("word").alias("w")), F.struct(F.lit(1).alias("kind"), F.reverse("word").alias("w")))
    each = each.withColumn("k", F.explode(kinds)).select("m", F.col("k.kind").alias("kind"), F.col("k.w").alias("w"), "known", "word", "n")
    return each.select("m", F.concat_ws("|", "kind", F.col("w").substr(F.lit(1), F.col("known"))).alias("list"), "known", "w", "word", "n")


def _dealt_on(lists: DataFrame) -> DataFrame:
    """Words of long lists, dealt to the lists in which half of the rest of the word is known as well.

    Of the ``m - known`` letters that may hold the edit (one more in the longer word) the first or the
    last half is as it is; for the latter the rest is turned round.
    """
    half = F.greatest(F.expr("(m - known) div 2"), F.lit(1))
    front = F.col("w").substr(F.lit(1), F.col("known"))
    rest = F.col("w").substr(F.col("known") + 1, F.length("w"))
    turned = F.array(F.struct(F.lit(0).alias("turn"), rest.alias("r")), F.struct(F.lit(1).alias("turn"), F.reverse(rest).alias("r")))
    each = lists.withColumn("front", front).withColumn("half", half).withColumn("t", F.explode(turned))
    return each.select(
        "m",
        F.concat_ws("|", "list", F.col("t.turn").cast("string"), F.col("t.r").substr(F.lit(1), F.col("half"))).alias("list"),
        (F.col("known") + F.col("half")).alias("known"),
        F.concat("front", F.col("t.r")).alias("w"),
        "word",
        "n",
    )


def near_pairs(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, n, other, other_n): every pair of ``words`` (word, n) one edit apart, both ways, once."""
    ready, open_lists = None, _lists(words)
    while True:
        # lists of one word have no pair; lists over ``most`` words with two letters or more to know are dealt on
        open_lists = common.written(open_lists)
        sizes = open_lists.groupBy("m", "list").agg(F.count(F.lit(1)).alias("words"), F.min("known").alias("least")).where("words > 1")
        sizes = common.written(sizes.select("m", "list", ((F.col("words") > most) & (F.col("m") - F.col("least") > 1)).alias("long")))
        kept = open_lists.join(sizes, ["m", "list"])
        done = kept.where(~F.col("long")).select("m", "list", "known", "w", "word", "n")
        ready = done if ready is None else ready.unionByName(done)
        if sizes.where("long").isEmpty():
            break
        open_lists = _dealt_on(kept.where("long").drop("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            here = pa.Table.from_batches([batch])
            held = here if held is None else pa.concat_tables([held, here])
            if held.num_rows < 1 << 15 and held.nbytes < WORD_BYTES:
                continue
            last = (held.column("m")[-1].as_py(), held.column("list")[-1].as_py())
            cut = held.num_rows
            while cut and (held.column("m")[cut - 1].as_py(), held.column("list")[cut - 1].as_py()) == last:
                cut -= 1
            if cut:
                yield from _pairs_of(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from _pairs_of(held)

    sorted_lists = ready.repartition("m", "list").sortWithinPartitions("m", "list", "w")
    return common.map_arrow(sorted_lists, run, "word string, n long, other string, other_n long").dropDuplicates(["word", "other"])


def _pairs_of(held: pa.Table) -> Iterator[pa.RecordBatch]:
    held = held.combine_chunks()
    m = held.column("m").to_numpy()
    keys = held.column("list").combine_chunks().dictionary_encode().indices.to_numpy()
    group = np.concatenate([[0], np.cumsum((m[1:] != m[:-1]) | (keys[1:] != keys[:-1]))])
    known = held.column("known").to_numpy()
    letters = [w.encode("latin-1") for w in held.column("w").to_pylist()]
    size = np.array([len(w) for w in letters])
    # chunks of whole lists whose letter matrix stays small
    bounds = np.append(np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])), len(group)).tolist()
    a = 0
    for k in range(1, len(bounds)):
        b = bounds[k]
        more = bounds[k + 1] if k + 1 < len(bounds) else None
        if more is not None and (more - bounds[a]) * (int(size[bounds[a] : more].max()) + 2) < WORD_BYTES:
            continue
        low = bounds[a]
        width = int(size[low:b].max())
        matrix = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in letters[low:b]), np.uint8).reshape(b - low, width)
        i, j = near_in_lists(matrix, size[low:b], group[low:b], known[low:b])
        if len(i):
            own, other = held.take(pa.array(i + low)), held.take(pa.array(j + low))
            columns = [own.column("word"), own.column("n"), other.column("word"), other.column("n")]
            yield from pa.table(columns, names=["word", "n", "other", "other_n"]).to_batches(max_chunksize=1 << 16)
        a = k


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form, by doubling: the form's form, and so on (forms grow, so chains end)."""
    links = common.written(forms.select("word", F.col("form").alias("root")))
    while True:
        above = links.select(F.col("word").alias("a_word"), F.col("root").alias("a_root"))
        links = links.join(above, F.col("root") == F.col("a_word"), "left")
        links = common.written(links.select("word", F.coalesce("a_root", "root").alias("root"), F.col("a_root").isNotNull().alias("moved")))
        if links.where("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def group_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO, slips: int = 0, most: int = MOST
) -> DataFrame:
    """Per word of the vocabulary: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    words = common.written(word_counts(docs, id_col, text_col, shortest, slips).where(F.col("n") >= least))
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("other")))
    near = near_pairs(words, most).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"), F.max("n").alias("own_n"))
    enough = -F.col("best.minus") >= F.col("own_n") * ratio
    near = common.written(near.select("word", "n_near", F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n")))
    roots = _roots(near.where("form is not null"))
    found = words.join(near, "word", "left").join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form_n").cast("long").alias("form_n"))


_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(s))), lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

ORACLE_SQL = f"""
WITH RECURSIVE found AS (
  SELECT doc_id, unnest(list_transform(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+'),
    lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS run
  FROM documents
), grouped AS (SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS s, count(*) AS n FROM found WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (SELECT run, n, {_CRC32} AS h FROM grouped
), slipped AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed
), words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n FROM near GROUP BY word
), forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best b USING (word)
), chain AS (SELECT word, word AS root FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c USING (word) JOIN forms e ON e.word = c.root AND e.form IS NULL"""
