"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

1. A text is cut into chunks where its own content says so: at white space between certain
   characters (one blank in some tens), once a chunk has ``SMALLEST`` characters, and after
   ``LARGEST`` characters at the latest. After an edit the cuts fall into step again within a chunk
   or two. The chunks concatenate to the text again, so equal texts have equal chunk lists and
   equal chunk lists mean equal texts.
2. The chunks of all documents are deduplicated to identifiers. An identifier is the 64-bit hash
   of a chunk; it is verified by the SHA-256 of the chunks that carry it. If any identifier stands
   for two contents, the SHA-256 values themselves become the identifiers.
3. A document's recipe is its ordered identifier list. Recipes, not texts, are grouped: counts and
   the largest id of each recipe are aggregated before the shuffle (a group of copies costs a row
   per task, however large), and joined back to the documents' ids.

Long documents are never moved: what is shuffled per document is an id, a hash and eight bytes per
chunk.

Defined results: null text counts as empty; all empty texts are equal; a null id is smaller than
any id; rows that repeat both id and text are counted and, if theirs is the largest id, all marked
kept, since nothing tells them apart; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SMALLEST, LARGEST = 64, 2048
#: A cut is after white space that follows one of BEFORE and stands before one of AFTER.
BEFORE, AFTER = "cgks.;!?#$", "adiqyADIQY0-9"

ORACLE_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def chunks(text: Column, smallest: int = SMALLEST, largest: int = LARGEST) -> Column:
    """The content-defined chunks of a text, in order; they concatenate to the text."""
    pattern = rf"(?s).{{{smallest},{largest}}}?\s(?<=[{BEFORE}]\s)(?=[{AFTER}])|.{{1,{largest}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def ambiguous_identifiers(docs: DataFrame, text_col: str = "text", smallest: int = SMALLEST, largest: int = LARGEST, identifier=F.xxhash64) -> DataFrame:
    """Identifiers that stand for more than one chunk content."""
    cut = docs.select(F.explode(chunks(F.coalesce(F.col(text_col), F.lit("")), smallest, largest)).alias("chunk"))
    dictionary = cut.select(identifier(F.col("chunk")).alias("id"), F.unhex(F.sha2("chunk", 256)).alias("content")).distinct()
    return dictionary.groupBy("id").count().where("count > 1")


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", smallest: int = SMALLEST, largest: int = LARGEST, identifier=F.xxhash64) -> DataFrame:
    """(id, text_sha256, recipe) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        F.sha2(text, 256).alias("text_sha256"),
        F.transform(chunks(text, smallest, largest), lambda c: identifier(c)).alias("recipe"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", smallest: int = SMALLEST, largest: int = LARGEST, identifier=F.xxhash64) -> DataFrame:
    """Per row: id, ``keep_id`` (largest id of its group of equal texts), ``group_size``, ``kept``, ``text_sha256``."""
    if not ambiguous_identifiers(docs, text_col, smallest, largest, identifier).isEmpty():
        identifier = _content_hash
    own = recipes(docs, id_col, text_col, smallest, largest, identifier)
    groups = own.groupBy("recipe").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return own.join(groups, "recipe").select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def _content_hash(chunk: Column) -> Column:
    return F.sha2(chunk, 256)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = deduplicate(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("kept_id"), F.col("text_sha256").alias("kept_sha")).distinct()
    same = docs[id_col].eqNullSafe(kept["kept_id"]) & (F.sha2(F.coalesce(docs[text_col], F.lit("")), 256) == kept["kept_sha"])
    return docs.join(kept, same, "left_semi")
