"""Chat formatting with a loss mask aligned to token offsets.

A conversation (its rows ordered by turn) is rendered whole into one string, which is encoded once
with character offsets. The turns' character spans and the tokens' character spans are both sorted,
so the tokens of a span are found by binary search; the tokens inside assistant spans form the
loss mask.

The template marks a turn by control strings: ``[SYS]..[/SYS]`` system, ``[INST]..[/INST]`` user,
``[ASST]..</s>`` assistant, ``[ROLE]role[TEXT]text</s>`` any other role, after an opening ``<s>``.
A control string inside a role or text is escaped by a backslash after its first character (one
more where there are some already), so it is no control string any longer and comes back exactly
by taking one backslash away. Control strings are special tokens of the encoder; a token therefore
never lies across the border of a turn.

Turns are gathered per conversation, the unit that is rendered; rows beyond that are never brought
together, whatever turns or texts conversations share.

Defined results: null text or role counts as empty; rows of equal turn number are ordered by role
and text; rows without a conversation id form one conversation with a null id; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from starbeam.llm import common

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ASST]", "[ROLE]", "[TEXT]")
#: role -> (before, after); any other role is written out.
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ASST]", "</s>")}

_TAILS = "|".join(re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True))
_ESCAPE = re.compile(rf"([<\[])(\\*)(?=(?:{_TAILS}))")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)(?=(?:{_TAILS}))")
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted conversation, character span of each turn's escaped text in it)."""
    parts, spans, size = ["<s>"], [], 3
    for role, text in turns:
        before, after = MARKS.get(role) or (f"[ROLE]{escape(role)}[TEXT]", "</s>")
        body = escape(text)
        parts += [before, body, after]
        spans.append((size + len(before), size + len(before) + len(body)))
        size += len(before) + len(body) + len(after)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, role, opened = [], None, {before: r for r, (before, _) in MARKS.items()}
    place = 0
    for m in _CONTROL.finditer(formatted):
        inside, mark = formatted[place : m.start()], m.group(0)
        place = m.end()
        if mark == "[TEXT]":
            role = unescape(inside)
        elif mark in opened:
            role = opened[mark]
        elif mark not in ("<s>", "[ROLE]"):
            turns.append((role or "", unescape(inside)))
            role = None
    return turns


def make_encoder(definition: bytes):
    """Tokenizer with the control strings as special tokens and untrimmed offsets."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_str(definition.decode("utf-8"))
    tokenizer.no_padding()
    tokenizer.no_truncation()
    tokenizer.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROL])
    return tokenizer


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]], roles: list[str], learned: str = "assistant") -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(mask over tokens, per learned span the range of its tokens), by binary search of the sorted spans."""
    mask = np.zeros(len(offsets), np.int8)
    wanted = np.array([s for s, r in zip(spans, roles) if r == learned], np.int64).reshape(-1, 2)
    first = np.searchsorted(offsets[:, 1], wanted[:, 0], "right")
    last = np.searchsorted(offsets[:, 0], wanted[:, 1], "left")
    ranges = [(a, max(a, b)) for a, b in zip(first.tolist(), last.tolist())]
    for a, b in ranges:
        mask[a:b] = 1
    return mask, ranges


def masked_text(formatted: str, offsets: np.ndarray, ranges: list[tuple[int, int]]) -> list[str]:
    """The text under each range of tokens, unescaped."""
    return [unescape(formatted[offsets[a, 0] : offsets[b - 1, 1]]) if b > a else "" for a, b in ranges]


def conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): one row per conversation, turns in order."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def format_conversations(rows: DataFrame, tokenizer_path: str, batch: int = 64, **columns: str) -> DataFrame:
    """Per conversation: ``formatted``, ``turn_spans``, ``token_ids``, ``token_starts``, ``token_ends``, ``loss_mask``."""
    sent = rows.sparkSession.sparkContext.broadcast(common.model_file(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for whole in batches:
            encoder = encoder or make_encoder(sent.value)
            for i in range(0, whole.num_rows, batch):
                part = whole.slice(i, batch)
                turns = [[(t["role"], t["text"]) for t in c] for c in part.column("turns").to_pylist()]
                rendered = [render(c) for c in turns]
                out = []
                for c, (text, spans), encoded in zip(turns, rendered, encoder.encode_batch([r[0] for r in rendered], add_special_tokens=False)):
                    offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
                    mask, _ = loss_mask(offsets, spans, [r for r, _ in c])
                    out.append((text, [r for r, _ in c], [x for s in spans for x in s], encoded.ids, offsets[:, 0], offsets[:, 1], mask))
                kinds = (pa.string(), pa.list_(pa.string()), *(pa.list_(pa.int32()),) * 4, pa.list_(pa.int8()))
                names = ("formatted", "roles", "turn_spans", "token_ids", "token_starts", "token_ends", "loss_mask")
                yield pa.record_batch([part.column("conv_id"), *(pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds))], names=["conv_id", *names])

    numbers = T.ArrayType(T.IntegerType())
    found = conversations(rows, **{f"{k}_col": v for k, v in columns.items()})
    schema = T.StructType([
        T.StructField("conv_id", found.schema["conv_id"].dataType),
        T.StructField("formatted", T.StringType()),
        T.StructField("roles", T.ArrayType(T.StringType())),
        *(T.StructField(n, numbers) for n in ("turn_spans", "token_ids", "token_starts", "token_ends")),
        T.StructField("loss_mask", T.ArrayType(T.ByteType())),
    ])
    return common.map_arrow(found, run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """The digest columns, from the formatted strings and token masks alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                text = batch.column("formatted")[row].as_py()
                starts, ends, mask = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in ("token_starts", "token_ends", "loss_mask"))
                turns = parse(text)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
                learned = [unescape(text[starts[a] : ends[b - 1]]) for a, b in zip(edges[::2], edges[1::2])]
                told, loss = hashlib.sha256(), hashlib.sha256()
                for r, t in turns:
                    told.update(f"{r}\n{t}\n".encode())
                for t in learned:
                    loss.update(t.encode())
                out.append((len(turns), told.hexdigest(), sum(map(len, learned)), loss.hexdigest(), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
            yield pa.record_batch([batch.column("conv_id"), *(pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds))], names=["conv_id", *names])

    kind = formatted.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])
    return common.map_arrow(formatted.select("conv_id", "formatted", "token_starts", "token_ends", "loss_mask"), run, schema)
