"""Registered queries of this package: one per operator over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starbeam.llm import bpe, chat, decontam, exact_dedup, html_extract, jaccard_join, merkle, near_dup, secret_scan, spelling, substring_dedup, token_counts, toxicity
from starbeam.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), wordless_apart=True)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], rows.schema)
    return chat.read_back(chat.format_conversations(rows.unionByName(extra), vocabulary("byte_bpe_50k.json")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), keep_ids=False)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(substring_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"), slips=spelling.SLIPS)


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(table(spark, sf_dir, "documents"), altered=merkle.line_breaks_deleted())
    return merkle.report(found)


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (op1_html_extract, op2_minhash_dedup, op3_exact_dedup, op4_chat_format, op5_decontamination, op6_toxicity, op7_byte_bpe, op8_secret_scan, op9_substring_dedup, op10_token_counts, op11_spelling_variants, op12_jaccard_join, op13_merkle_manifest)}
ORACLE_SQL: dict[str, str] = {"op3_exact_dedup": exact_dedup.ORACLE_SQL, "op11_spelling_variants": spelling.ORACLE_SQL, "op13_merkle_manifest": merkle.ORACLE_SQL}
