import random
import re

import numpy as np
import pytest

from starbeam.llm import substring_dedup as S

from .conftest import sha

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(pairs):
    first = {}
    for i, t in pairs:
        w = WORD.findall(t or "")
        for a in range(len(w) - 12) if i is not None else ():
            key = tuple(w[a : a + 13])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in pairs:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for a in range(len(w) - 12) if i is not None else ():
            if first[tuple(w[a : a + 13])] < i:
                gone[a : a + 13] = [True] * 13
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=str)


def rows(docs):
    return sorted((tuple(r) for r in S.report(S.remove_repeats(docs)).collect()), key=str)


def _pairs(seed, vocabulary, n, longest):
    rnd = random.Random(seed)
    passages = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(10, 40))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [rnd.choice(passages) if rnd.random() < 0.3 else " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 20))) for _ in range(rnd.randint(0, longest))]
        out.append((rnd.randint(0, 10**6), rnd.choice([" ", "\n", " \t"]).join(parts)))
    return out


@pytest.mark.parametrize("vocabulary", [[f"w{i}" for i in range(400)], ["a", "b"]])
@pytest.mark.parametrize("hot", [S.HOT, 2])
def test_random_texts_against_brute_force(make_docs, monkeypatch, vocabulary, hot):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "SHARD_SEGMENTS", 40)
    pairs = _pairs(5, vocabulary, 120, 5)
    assert rows(make_docs(pairs)) == brute(pairs)


PASSAGE = " ".join(f"p{i}" for i in range(60))
CASES = [
    (5, PASSAGE), (3, "start " + PASSAGE + " end"), (9, None), (8, ""), (7, PASSAGE), (7, PASSAGE), (7, "other text under the same id " + PASSAGE), (None, PASSAGE), (2, " ".join(f"p{i}" for i in range(12))),
    (1, " ".join(f"p{i}" for i in range(20, 33))), (11, "x " * 3000 + PASSAGE), (10, "x " * 40), (12, "é😀 " * 15), (13, "é😀\n" * 14),
]


@pytest.mark.parametrize("clash", [False, True])
def test_defined_cases(make_docs, clash):
    assert rows(make_docs(CASES, clash)) == brute(CASES)


def test_empty_table_and_nothing_shared(make_docs):
    assert rows(make_docs([])) == []
    pairs = [(1, "a b c"), (2, " ".join(f"q{i}" for i in range(30)))]
    assert rows(make_docs(pairs)) == brute(pairs)


def test_backward_search_counts_occurrences():
    rng = np.random.default_rng(6)
    text = np.concatenate([rng.integers(1, 4, 500), [0], rng.integers(1, 4, 300), [0]])
    index = S.FMIndex(text, 5)
    patterns = np.stack([text[a : a + 5] for a in range(400) if (text[a : a + 5] > 0).all()])
    low, high = index.intervals(patterns)
    for p, a, b in zip(patterns, low, high):
        n = sum((text[i : i + 5] == p).all() for i in range(len(text) - 4))
        assert max(b - a, 1) == n or (b - a <= 1 and n == 1)


def test_minimizers_depend_on_the_window_alone():
    rng = np.random.default_rng(8)
    words = rng.integers(0, 50, 300).astype(np.uint64)
    whole = S.minimizers(words)
    assert all(whole[i] == S.minimizers(words[i : i + 13])[0] for i in range(len(words) - 12))


def test_test_data(tables):
    docs = tables("documents")
    assert rows(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
