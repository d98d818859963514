"""The exact join against all pairs, on made-up chains and groups and on the test tables."""

import random
import re

import numpy as np
import pytest

from starbeam.llm import jaccard_join as jj
from tests.llm.conftest import ascii_lower


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", ascii_lower(text or ""))
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)}


def plain(pairs, percent=85):
    sets = [shingle_set(t) for _, t in pairs]
    parent = {i: i for i, _ in pairs if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, _) in enumerate(pairs):
        for m in range(k):
            j = pairs[m][0]
            a, b = sets[k], sets[m]
            if i is None or j is None or not a or not b or min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
                continue
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else root(i)) for (i, _), s in zip(pairs, sets)), key=str)


def got(docs, **options):
    return sorted((tuple(r) for r in jj.join_documents(docs, **options).collect()), key=str)


def corpus(seed, chains=6, length=40):
    """Chains of texts that each differ a little from the one before, copies, texts at the threshold, unrelated texts with a common passage."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(5000)
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(chains):
        words = [word() for _ in range(rng.choice([5, 12, 60, 200]))]
        for _ in range(rng.choice([2, length])):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = word()
    texts += [" ".join(passage + [word() for _ in range(12)]) for _ in range(30)]
    texts += [" ".join(passage + [word() for _ in range(rng.choice([8, 9, 10, 11]))]) for _ in range(30)]
    texts += ["One  two\tthree four", "one two three four", "ONE two three", "one two three", "", " \n", None, "É b c d e", "é b c d e"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("region_docs,percent", [(256, 85), (12, 85), (12, 60)])
def test_equals_all_pairs(make_docs, monkeypatch, region_docs, percent):
    monkeypatch.setattr(jj, "REGION_DOCS", region_docs)
    texts = corpus(3)
    pairs = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (5, texts[5]), (5, texts[9]), (900, "x y " * 40_000), (901, "x y " * 40_000 + "z")]
    found = got(make_docs(pairs, clash=True), percent=percent)
    assert found == plain(pairs, percent)
    assert len({c for _, _, c in found}) < len(texts) - 50


def test_empty_table(make_docs):
    assert got(make_docs([])) == []
    assert got(make_docs([(1, None), (2, "")])) == [(1, 0, 1), (2, 0, 2)]


def test_equals_all_pairs_on_the_test_table(tables):
    pairs = [(r.doc_id, r.text) for r in tables("documents").collect()]
    found = got(tables("documents"))
    assert found == plain(pairs) and any(i != c for i, _, c in found)


def test_border_documents_meet_in_a_cell():
    """Every pair within t shares a cell, whatever the pivots."""
    rng = np.random.default_rng(1)
    base = [set(rng.integers(0, 400, 60).tolist()) for _ in range(5)]
    sets = []
    for b in base:
        for _ in range(30):
            own = set(b)
            for _ in range(int(rng.integers(0, 25))):
                own.discard(next(iter(own)))
                own.add(int(rng.integers(0, 400)))
            sets.append(own)
    d = np.array([[1 - len(a & b) / len(a | b) for b in sets] for a in sets])
    for t in (0.15, 0.4):
        cells = jj.cells_of(d[::17], t)
        shared = np.zeros(d.shape, bool)
        for c in cells:
            shared[np.ix_(c, c)] = True
        assert shared[d <= t].all()


def test_region_links_join_all_components():
    rng = random.Random(2)
    sets = []
    for _ in range(8):
        own = set(rng.sample(range(10**6), 80))
        for _ in range(60):
            sets.append(np.array(sorted(own), np.uint64))
            own = set(own)
            own.remove(rng.choice(sorted(own)))
            own.add(rng.randrange(10**6))
    order = list(range(len(sets)))
    rng.shuffle(order)
    sets = [sets[i] for i in order]

    def classes(links):
        parent = list(range(len(sets)))
        for a, b in links:
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            parent[max(a, b)] = min(a, b)
        out = []
        for x in range(len(sets)):
            while parent[x] != x:
                x = parent[x]
            out.append(x)
        return out

    plain_sets = [set(s.tolist()) for s in sets]
    want = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(plain_sets[a] & plain_sets[b]) >= 85 * len(plain_sets[a] | plain_sets[b])]
    assert classes(jj.region_links(sets)) == classes(want)
