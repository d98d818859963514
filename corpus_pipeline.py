"""Corpus pipeline: the stages from raw documents to token ids, each over all that its predecessor kept.

``STAGES`` is a list of (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet to the shared folder and read again as the next one's docs.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starbeam.llm import bpe, decontam, exact_dedup, near_dup, toxicity
from starbeam.llm.common import table
from starbeam.llm.queries import vocabulary
from starbeam.session import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5; the lexicon is learned from the labelled rows among them."""
    return toxicity.keep_clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the row with the smallest id."""
    return near_dup.keep_one(docs, wordless_apart=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every kept document, with the hashes that prove the round trip."""
    return bpe.encode_texts(docs, vocabulary("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

ORACLE_SQL = None  # a learned score and hashed sketches cannot be written in SQL; the tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two stages the rows are written and read again."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
