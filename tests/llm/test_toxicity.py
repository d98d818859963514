import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from starbeam.llm import textscan as ts
from starbeam.llm import toxicity as T

LABELS = "doc_id long, quality int, toxic int"


def folded(text):
    data, offsets = ts.flat_text(pa.array([text, "next"]))
    out, rows = T.fold(data, offsets)
    return out[rows[0] : rows[1]].strip()


@pytest.mark.parametrize("text,expected", [
    ("You IDIOT!", "you idiot"), ("1d10t", "idiot"), ("ѕtupіd", "stupid"), ("mоr0n", "moron"), ("id​i­ot", "idiot"), ("ídïôt", "idiot"), ("p@thetic $cum a$hat wow$", "pathetic cum ashat wow"), ("***word###", "word"), ("Ｉｄｉｏｔ", "idiot"), ("", ""),
])
def test_folding(text, expected):
    assert folded(text) == expected


def test_matches_are_whole_words_stems_and_exceptions():
    model = T.Model({" idiot ": 2.0, " lowe": 1.5, " trash ": 3.0}, ("trash can",), (-4.0, 4.0, 0.5))
    texts = ["idiot idiots", "lowe loweis xlowei", "trash can trash", None, "", "plain"]
    data, offsets = ts.flat_text(pa.array(texts))
    total, words = T.evidence(model.automaton(), data, offsets)
    assert total.tolist() == [2.0, 1.5, 3.0, 0.0, 0.0, 0.0] and words.tolist()[3:5] == [0, 0]


def _corpus(n=600):
    rnd = random.Random(9)
    common = ["".join(rnd.choice("aeioubcdfgl") for _ in range(rnd.randint(2, 9))) for _ in range(800)]
    bad = ["zorgnik", "plimfax", "grubbel"]
    pairs, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.2
        words = [rnd.choice(common) for _ in range(rnd.randint(20, 120))]
        if toxic:
            for _ in range(3):
                words[rnd.randrange(len(words))] = rnd.choice(bad) if rnd.random() < 0.6 else "vexu" + rnd.choice(["", "a", "bo", "cil", "dan"]) + rnd.choice("aeiou")
        pairs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return pairs, labels


@pytest.mark.parametrize("clash", [False, True])
def test_learned_lexicon_holds_on_rows_held_out(spark, make_docs, clash):
    pairs, labels = _corpus()
    docs = make_docs([*pairs, (None, "zorgnik"), (10_000, None), (10_001, ""), (10_002, "z0rgnik plimf@x gRubbel"), (10_003, "calm " * 50000)], clash)
    model = T.learn(docs, spark.createDataFrame(labels, LABELS))
    rows = T.score(docs, model).collect()
    assert len(rows) == len(pairs) + 5
    truth = {i: y for i, _, y in labels}
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    judged = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p == y for p, y in judged]) > 0.97
    got = {r.doc_id: r.predicted for r in rows}
    assert got[10_000] == got[10_001] == got[10_003] == 0 and got[10_002] == 1


def test_held_out_labels_are_never_learned_from(spark, make_docs):
    pairs, labels = _corpus(200)
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels]
    docs = make_docs(pairs)
    a, b = (T.learn(docs, spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert a.weights == b.weights and a.coefficients == b.coefficients


def test_empty_tables_and_kept_rows(spark, make_docs):
    none = spark.createDataFrame([], LABELS)
    model = T.learn(make_docs([(1, "x")]), none)
    assert model.weights == T.default_model().weights
    assert T.score(make_docs([]), model).count() == 0
    docs = make_docs([(1, "you idiot, you moron"), (2, "kind words"), (None, None)], clash=True)
    kept = T.keep_clean(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, None}
    odd = spark.createDataFrame([(1, 1, None), (None, 1, 1), (1, 1, 1), (1, 1, 0)], LABELS)
    T.learn(make_docs([(1, "x")]), odd)


EDGES = ["hello", "$cum", "hello ", "$cum", "big trash", "can do", "a$", "$b", "", None, "@", "x@", "\u200b$", "idi", "ot idiot", "trash can", "wow$ $a trash", "can", "\n", "é$é"]


def plain_fold(text):
    """Folding of one text, letter by letter."""
    table, text = T.fold_table(), text or ""
    out = [int(table[ord(c)]) for c in text]
    for sign, letter in T.SIGNS.items():
        before = list(out)
        for k, c in enumerate(text):
            if c == sign and 0 < k < len(text) - 1 and before[k - 1] != 0x20 and before[k + 1] != 0x20:
                out[k] = ord(letter)
    return "".join(chr(p) for p in out if p).split(" ") if text else []


def test_a_row_is_folded_by_itself():
    data, offsets = ts.flat_text(pa.array(EDGES))
    out, rows = T.fold(data, offsets)
    alone = []
    for text in EDGES:
        d, o = ts.flat_text(pa.array([text], pa.string()))
        t, r = T.fold(d, o)
        alone.append(t[r[0] : r[1]])
    assert [out[a:b] for a, b in zip(rows[:-1], rows[1:])] == alone
    assert [a.split() for a in alone] == [[w for w in plain_fold(t) if w] for t in EDGES]


def plain_evidence(model, text):
    """Weights of the matches of one text by plain search: per start the heaviest, none inside an exception phrase."""
    words = [w for w in plain_fold(text) if w]
    line = " " + " ".join(words) + " " if words else " "
    inside = set()
    for phrase in model.exceptions:
        k = line.find(f" {phrase} ")
        while k >= 0:
            inside.add((k, k + len(phrase) + 1))
            k = line.find(f" {phrase} ", k + 1)
    best = {}
    for pattern, weight in model.weights.items():
        k = line.find(pattern)
        while k >= 0:
            end = k + len(pattern) - 1
            goes_on = end + 1 < len(line) and line[end + 1] != " "
            if (pattern.endswith(" ") or goes_on) and not any(a <= k and end <= b for a, b in inside):
                best[k] = max(best.get(k, 0), weight)
            k = line.find(pattern, k + 1)
    return sum(best.values()), len(words)


def test_evidence_equals_plain_search_whatever_stands_beside():
    model = T.Model({" idiot ": 2.0, " lowe": 1.5, " trash ": 3.0, " cum ": 3.0, " tra": 1.0}, ("trash can", "wow trash"), (-4.0, 4.0, 0.5))
    rnd = random.Random(3)
    parts = ["idiot", "trash", "can", "wow", "cum", "lower", "lowe", "$cum", "tr@sh", "x", " ", ".", "  ", "train"]
    texts = EDGES + ["".join(rnd.choice(parts) + rnd.choice([" ", "", "-"]) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    data, offsets = ts.flat_text(pa.array(texts))
    total, words = T.evidence(model.automaton(), data, offsets)
    assert list(zip(total.tolist(), words.tolist())) == [plain_evidence(model, t) for t in texts]


def test_scores_do_not_depend_on_partitions(make_docs):
    docs = make_docs(list(enumerate(EDGES * 8)))
    found = [sorted((r.doc_id, r.score) for r in T.score(docs.repartition(n), T.default_model()).collect()) for n in (1, 7, 50)]
    assert found[0] == found[1] == found[2]


def test_many_exceptions_are_fast():
    import time

    model = T.Model({" trash ": 3.0}, ("trash can",), (-4.0, 4.0, 0.5))
    data, offsets = ts.flat_text(pa.array(["trash can " * 100_000 + "trash"]))
    automaton, began = model.automaton(), time.time()
    total, _ = T.evidence(automaton, data, offsets)
    assert total.tolist() == [3.0] and time.time() - began < 3
