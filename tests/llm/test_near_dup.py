import random
import re
from collections import Counter

import numpy as np
import pytest

from starbeam.llm import near_dup as N

from .conftest import ascii_lower

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def multiset(text):
    w = WORD.findall(ascii_lower(text or ""))
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 1.0


def brute(pairs):
    """id -> (text class, class, size) by comparing everything."""
    texts = {}
    for i, t in pairs:
        if i is not None:
            texts.setdefault(i, multiset(t))
    own = {}
    for i in sorted(texts):
        own.setdefault(frozenset(texts[i].items()), []).append(i)
    same = {i: m[0] for m in own.values() for i in m}
    parent = {m[0]: m[0] for m in own.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    heads = sorted(parent)
    for k, a in enumerate(heads):
        for b in heads[:k]:
            if texts[a] and texts[b] and similarity(texts[a], texts[b]) >= N.THRESHOLD:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    classes = {i: root(same[i]) for i in texts}
    size = Counter(classes.values())
    return {i: (same[i], classes[i], size[classes[i]]) for i in texts}


def found(docs):
    return {r.doc_id: (r.text_class, r.class_id, r.class_size) for r in N.near_duplicates(docs).collect() if r.doc_id is not None}


def _family(rnd, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return " ".join(words)


def test_families_against_brute_force(make_docs):
    rnd, pairs = random.Random(2), []
    for _ in range(8):
        base = " ".join(f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(60, 300)))
        pairs += [(rnd.randrange(10**6), _family(rnd, base, rnd.choice([0, 1, 2, 5, 30]))) for _ in range(12)]
    pairs += [(i, "repeated line here again and again " * i) for i in range(1, 40)]
    assert found(make_docs(pairs)) == brute(pairs)


CASES = [(1, None), (2, ""), (3, "?!"), (4, "one two"), (5, "One, TWO!"), (6, "one two three"), (7, "x " * 5000), (8, "x " * 4100), (9, "x " * 3000), (None, "one two"), (10, "one two three four five"), (11, "one two three four five"), (11, "one two three four five")]


@pytest.mark.parametrize("clash", [False, True])
def test_defined_cases(make_docs, clash):
    docs = make_docs(CASES, clash)
    assert found(docs) == brute(CASES)
    rows = N.near_duplicates(docs).collect()
    assert len(rows) == len(CASES)
    assert [tuple(r) for r in rows if r.doc_id is None] == [(None, None, None, None, 0, None)]


def test_empty_table_and_kept_rows(make_docs):
    assert N.near_duplicates(make_docs([])).count() == 0
    # a row without an id is a row like any other: it goes if it is a copy, and comes last among copies
    cases = sorted([*CASES, (None, "unlike the rest"), (4, "same id, other text")], key=lambda c: (c[0] is None, c[0] or 0))
    docs = make_docs(cases, clash=True)
    kept = N.keep_one(docs)
    want = [cases[n] for n, (_, c, _) in brute(list(enumerate((t for _, t in cases)))).items() if n == c]
    assert kept.columns == docs.columns
    # wordless texts are one class here, and which of an id's equal rows stays is not told
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str) == sorted(((i, t or "") for i, t in want), key=str)
    assert (None, "one two") not in want and (None, "unlike the rest") in want and (4, "same id, other text") in want


def test_signatures_estimate_weighted_jaccard_without_bias():
    rng = np.random.default_rng(1)
    errors = []
    for top in (2, 8, 40):
        for _ in range(40):
            a = {int(k): int(rng.integers(1, top)) for k in rng.integers(0, 1 << 52, 50)}
            b = {k: v for k, v in ((k, max(0, v + int(rng.integers(-2, 3)))) for k, v in a.items()) if v and rng.random() < 0.9}
            doc = np.repeat([0, 1], [len(a), len(b)])
            item = np.array([*sorted(a), *sorted(b)], np.uint64)
            weight = np.array([*(a[k] for k in sorted(a)), *(b[k] for k in sorted(b))])
            sig = N.signatures(doc, item, weight, 2)
            errors.append((sig[0] == sig[1]).mean() - similarity(Counter(a), Counter(b)))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.09


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 200), (300, 200)], "a long, b long")
    got = {r.id: r.component for r in N.components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 200: 100, 300: 100}


def test_wordless_texts_share_a_class_only_if_equal(spark, make_docs, tmp_path):
    import corpus_pipeline
    from starbeam.llm import queries

    texts = {1: "?!", 2: "====", 3: "", 4: None, 5: "?!", 6: "? !", 7: "one two", 8: "One, two!", 9: " "}
    docs = make_docs(list(texts.items()))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.text_class, r.class_id, r.class_size) for r in queries.op2_minhash_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (1, 1, 2), 2: (2, 2, 1), 3: (3, 3, 2), 4: (3, 3, 2), 5: (1, 1, 2), 6: (6, 6, 1), 7: (7, 7, 2), 8: (7, 7, 2), 9: (9, 9, 1)}
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect()} == {1, 2, 3, 6, 7, 9}
