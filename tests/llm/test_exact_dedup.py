import pytest

from starbeam.llm import exact_dedup as X

from .conftest import sha


def expected(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in pairs:
        own = groups[t or ""]
        keep = max((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), i == keep, sha(t or "")))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


LONG = "Sentence number one. Another, longer sentence follows here!\n" * 2000
PAIRS = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "A"), (6, "a "), (7, LONG), (8, LONG), (9, LONG + "x"), (10, "y" * 50000), (11, "y" * 50000), (12, "y" * 49999), (None, "a"), (None, "only null"), (2, "a"), (13, "é😀"), (14, "é😀")]


@pytest.mark.parametrize("clash", [False, True])
def test_against_brute_force(make_docs, clash):
    assert rows(X.deduplicate(make_docs(PAIRS, clash))) == expected(PAIRS)


def test_ambiguous_identifiers_fall_back_to_content_hashes(make_docs):
    """An identifier that stands for two contents is noticed, and the result stays right."""
    from pyspark.sql import functions as F

    docs = make_docs(PAIRS)
    assert X.ambiguous_identifiers(docs).isEmpty()
    assert not X.ambiguous_identifiers(docs, identifier=F.length).isEmpty()
    assert rows(X.deduplicate(docs, identifier=F.length)) == expected(PAIRS)


def test_chunks_concatenate_to_the_text_and_keep_their_bounds(make_docs):
    from pyspark.sql import functions as F

    for r in make_docs(PAIRS).select("text", X.chunks(F.coalesce("text", F.lit(""))).alias("c")).collect():
        assert "".join(r.c) == (r.text or "")
        assert all(len(c) <= X.LARGEST + 1 for c in r.c)


def test_an_edit_changes_few_chunks(make_docs):
    from pyspark.sql import functions as F

    text = "".join(f"Sentence number {i} tells of {i * i} apples and trees. " for i in range(500))
    a, b = (set(r.c) for r in make_docs([(1, text), (2, "Put in front. " + text)]).select(X.chunks(F.col("text")).alias("c")).collect())
    assert len(a & b) > 0.8 * len(a)


def test_empty_table_and_kept_rows(make_docs):
    assert X.deduplicate(make_docs([])).count() == 0
    docs = make_docs([(1, "a"), (2, "a"), (3, None), (4, ""), (None, "z")], clash=True)
    kept = X.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id) == [(2, "a"), (4, "")]
    assert kept.count() == 3


def test_hot_group_plan_aggregates_before_the_shuffle(make_docs):
    from contextlib import redirect_stdout
    from io import StringIO

    with redirect_stdout(StringIO()) as out:
        X.deduplicate(make_docs([(i, "same") for i in range(300)] + [(999, "other")])).explain("simple")
    assert "partial_max" in out.getvalue() and "Python" not in out.getvalue() and "Arrow" not in out.getvalue()
