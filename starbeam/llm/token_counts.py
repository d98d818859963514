"""Token counts by a two-tier map-side lookup; no pre-token is ever shuffled.

The unit of lookup (a pre-token) is a run of text between ASCII white space. The vocabulary drops
white space and neither its merges nor its normaliser reach across it, so the count of a text is
the sum over its runs, and the library itself gives the count of each distinct run.

1. Every task scans all of its texts and keeps a bounded summary of its commonest runs (the
   ``summary`` largest counts). The summaries, not the runs, are added up, and the ``frequent``
   commonest runs over all documents become a hash table of run -> number of tokens, at most
   ``frequent`` entries of 12 bytes, which is broadcast. The table only saves time: results are
   the same with any table.
2. Every task looks up all runs of a few megabytes of text at once. Runs that the table lacks go
   through a cache in the worker (cleared at ``cache`` entries), and what is in neither is encoded
   by the library, each distinct run once.

Defined results: null text counts as empty (0 bytes, 0 tokens); a null id stays a row; repeated
rows each give a row; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starbeam.llm import common
from starbeam.llm import textscan as ts

FREQUENT = 1 << 15
SUMMARY = 1 << 14
CACHE = 1 << 19
LONGEST_FREQUENT = 64


def _tokenizer(definition: bytes):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition.decode("utf-8"))
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def _lengths(tokenizer, runs: list[bytes]) -> list[int]:
    encoded = tokenizer.encode_batch_fast([r.decode("utf-8", "replace") for r in runs], add_special_tokens=False)
    return [len(e.ids) for e in encoded]


def frequent_runs(docs: DataFrame, text_col: str = "text", frequent: int = FREQUENT, summary: int = SUMMARY) -> DataFrame:
    """(run, n): the commonest runs over all texts, from bounded summaries of every task (at most ``frequent`` rows)."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, runs = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, object)
        for batch in batches:
            for _, data, offsets in ts.text_groups(batch, text_col):
                h, s, e = ts.scan_words(data, offsets[:-1], ts.NOT_SPACE)
                short = np.flatnonzero(e - s <= LONGEST_FREQUENT)
                u, first, n = np.unique(h[short], return_index=True, return_counts=True)
                keep = n > 1
                u, n, at = u[keep], n[keep], short[first[keep]]
                both = np.concatenate([keys, u])
                merged, where = np.unique(both, return_inverse=True)
                total = np.bincount(where, np.concatenate([counts, n])).astype(np.int64)
                text = np.empty(len(merged), object)
                fresh = np.flatnonzero(~np.isin(u, keys))
                raw = data.tobytes()
                text[where[len(keys) + fresh]] = [raw[x:y] for x, y in zip(s[at[fresh]], e[at[fresh]])]
                text[where[: len(keys)]] = runs
                if len(merged) > 4 * summary:
                    best = np.argpartition(total, len(total) - 2 * summary)[-2 * summary :]
                    best.sort()
                    merged, total, text = merged[best], total[best], text[best]
                keys, counts, runs = merged, total, text
        best = np.argsort(-counts, kind="stable")[:summary]
        for i in range(0, len(best), 4096):
            part = best[i : i + 4096]
            yield pa.record_batch({"run": pa.array(list(runs[part]), pa.binary()), "n": pa.array(counts[part])})

    found = common.map_arrow(docs.select(text_col), summarise, "run binary, n long")
    return found.groupBy("run").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "run").limit(frequent)


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    frequent: int = FREQUENT,
    cache: int = CACHE,
) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens)."""
    spark = docs.sparkSession
    definition = common.model_file(tokenizer_path)
    # written first: the tasks' candidates for the top are merged by executors, the driver reads the result
    common_runs = [bytes(r.run) for r in common.written(frequent_runs(docs, text_col, frequent)).collect()]
    data = np.frombuffer(b"".join(common_runs), np.uint8)
    ends = np.cumsum([len(r) for r in common_runs], dtype=np.int64)
    starts = np.concatenate([[0], ends])[: len(ends)].astype(np.int64)
    keys = ts.range_hashes(data, starts, ends)
    sent = spark.sparkContext.broadcast((definition, keys, np.array(_lengths(_tokenizer(definition), common_runs), np.int32)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition, keys, values = sent.value
        tokenizer, table, known = _tokenizer(definition), ts.HashTable(keys, values), {}
        for batch in batches:
            for part, data, offsets in ts.text_groups(batch, text_col):
                h, s, e = ts.scan_words(data, offsets[:-1], ts.NOT_SPACE)
                n = table.get(h).astype(np.int64)
                miss = np.flatnonzero(n < 0)
                _, first, where = np.unique(h[miss], return_index=True, return_inverse=True)
                raw, at = data.tobytes(), miss[first]
                runs = [raw[x:y] for x, y in zip(s[at], e[at])]
                if len(known) > cache:
                    known.clear()
                new = [r for r in runs if r not in known]
                for i in range(0, len(new), 4096):
                    block = new[i : i + 4096]
                    known.update(zip(block, _lengths(tokenizer, block)))
                if runs:
                    n[miss] = np.array([known[r] for r in runs], np.int64)[where]
                sums = np.concatenate([[0], np.cumsum(n)])
                rows = ts.rows_of(s, offsets)
                tokens = sums[rows[1:]] - sums[rows[:-1]]
                yield pa.record_batch(
                    [part.column(id_col), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)],
                    names=[id_col, "n_bytes", "n_tokens", "over_limit"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return common.map_arrow(docs.select(id_col, text_col), count, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
