import random
import re

import pytest

from starbeam.llm import decontam as D

from .conftest import ascii_lower, sha

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(ascii_lower(text or ""))


def brute(pairs, items, window=10):
    phrases = {}
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            phrases.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    out = []
    for i, text in pairs:
        w = words(text)
        hit, found = [0] * len(w), set()
        for size in {len(p) for p in phrases}:
            for a in range(len(w) - size + 1):
                own = phrases.get(tuple(w[a : a + size]))
                if own:
                    found |= own
                    hit[a : a + size] = [1] * size
        out.append((i, len(w), sum(hit), len(found), sha(",".join(sorted(found))), sum(hit) > 0))
    return sorted(out, key=str)


def rows(matches):
    return sorted((tuple(r) for r in D.report(matches).collect()), key=str)


@pytest.fixture
def bench(spark):
    return lambda items: spark.createDataFrame(items, "item_id long, text string")


ITEMS = [(1, "The quick brown fox jumps over the lazy dog today and then sleeps"), (2, "short ITEM"), (3, None), (4, ""), (5, "The quick brown fox jumps over the lazy dog today and then sleeps"), (10, "a a a a a a a a a a a"), (11, "?!")]
PAIRS = [
    (1, "Before: the QUICK brown fox, jumps over the lazy-dog today; after"), (2, "the quick brown fox jumps over the lazy cat today and then sleeps"), (3, None), (4, ""), (5, "short item short item"), (6, "short"), (7, "item end"),
    (8, "a " * 25), (9, "a " * 9), (None, "short item"), (1, "Before: the QUICK brown fox, jumps over the lazy-dog today; after"), (12, ("filler words " * 20000) + ITEMS[0][1]), (13, "brown fox jumps over the lazy dog today and then sleeps"),
]


@pytest.mark.parametrize("clash,block", [(False, D.BLOCK_WORDS), (True, 3)])
def test_against_brute_force(make_docs, bench, clash, block):
    index = D.build_index(make_docs(PAIRS, clash), block_words=block)
    assert rows(D.search(index, D.phrase_blocks(bench(ITEMS)))) == brute(PAIRS, ITEMS)


def test_many_small_phrase_blocks_give_the_same_rows(make_docs, bench):
    blocks = D.phrase_blocks(bench(ITEMS), most=1)
    assert len(blocks) > 2
    assert rows(D.search(D.build_index(make_docs(PAIRS)), blocks)) == brute(PAIRS, ITEMS)


def test_random_texts_from_few_words(make_docs, bench):
    rnd = random.Random(3)

    def text(n):
        return " ".join(rnd.choice("abc") for _ in range(n))

    items = [(i, text(rnd.randint(1, 14))) for i in range(12)]
    pairs = [(i, text(rnd.randint(0, 60))) for i in range(200)]
    for window in (4, 10):
        got = D.search(D.build_index(make_docs(pairs)), D.phrase_blocks(bench(items), window=window))
        assert rows(got) == brute(pairs, items, window)


def test_proximity(make_docs, bench):
    items = [(1, "one two three four")]
    docs = make_docs([(1, "one two three four"), (2, "one two x three four"), (3, "one x x x x two three four"), (4, "four three two one"), (5, "one two three")])
    index, blocks = D.build_index(docs), D.phrase_blocks(bench(items), window=4)
    hits = {s: {r.doc_id for r in D.search(index, blocks, slop=s).where("n_hit > 0").collect()} for s in (0, 1)}
    assert hits == {0: {1}, 1: {1, 2}}


def test_empty_tables_and_kept_rows(make_docs, bench):
    assert D.decontaminate(make_docs([]), bench(ITEMS)).count() == 0
    assert rows(D.decontaminate(make_docs(PAIRS), bench([]))) == brute(PAIRS, [])
    docs = make_docs([(1, "x short item"), (2, "clean"), (None, "clean too"), (3, None)], clash=True)
    kept = D.keep_clean(docs, bench(ITEMS))
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == ["2", "3", "None"]


def test_test_data(tables):
    docs, bench = tables("documents"), tables("benchmark")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in bench.collect()]
    assert rows(D.decontaminate(docs, bench)) == brute(pairs, items)
