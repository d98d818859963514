"""Spelling variants against plain Python, on random vocabularies and on the test tables."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from starbeam.llm import spelling
from tests.llm.conftest import ascii_lower


def plain(pairs, shortest=6, least=5, ratio=5, slips=199):
    counts = Counter()
    for i, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slips and h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= least}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    forms, out = {}, []
    for w, n in words.items():
        around = [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size.get(size, ()) if near(w, v)]
        best = min(around, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
        out.append((w, forms[w], n, len(around), words[best] if forms[w] else None))
    roots = {}
    for w in words:
        r = w
        while forms[r]:
            r = forms[r]
        roots[w] = r
    return sorted((w, f, roots[w], n, k, fn) for w, f, n, k, fn in out)


def got(docs, **options):
    return sorted(tuple(r) for r in spelling.group_variants(docs, slips=199, **options).collect())


def key(rows):
    return [tuple("" if v is None else v for v in r) for r in rows]


@pytest.mark.parametrize("most", [4096, 3])
def test_random_vocabulary(make_docs, most):
    rng = random.Random(5)
    bases = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "x" * 5000, "x" * 5001, "x" * 4999 + "y"]
    words = []
    for b in bases:
        words += [b] * rng.choice([5, 7, 30, 200])
        for _ in range(4):
            k = rng.randrange(len(b))
            v = rng.choice([b[:k] + b[k + 1 :], b[:k] + "z" + b[k:], b[:k] + "É" + b[k + 1 :]])
            words += [v] * rng.choice([1, 5, 6, 40])
    rng.shuffle(words)
    pairs = [(i, " ".join(words[i::40]).replace("b", rng.choice("bB"))) for i in range(40)] + [(None, "aaaaaa aaaaaa"), (3, None), (3, ""), (41, "aaaaaa×aaaaaa÷ aaaaaa1aaaaaa")]
    docs = make_docs(pairs, clash=True)
    assert key(got(docs, most=most)) == key(plain(pairs))


def test_no_rows_and_rare_words(make_docs):
    assert got(make_docs([])) == []
    assert got(make_docs([(1, "a few short words"), (2, None)])) == []


def test_equals_sql_and_plain_python(tables, sf_small):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_small}/documents.parquet'")
    found = key(got(tables("documents")))
    assert found == key(sorted(con.execute(spelling.ORACLE_SQL).fetchall()))
    assert found == key(plain([(r.doc_id, r.text) for r in tables("documents").collect()])) and any(r[1] for r in found)


def test_crc32_of_ranges():
    data = np.frombuffer("é:abc".encode() + b"x" * 300, np.uint8)
    starts, ends = np.array([0, 3, 3, 5]), np.array([0, 6, 306, 70])
    seeds = np.array([zlib.crc32(b"17:")] * 4, np.uint32)
    assert spelling.crc32_of(data, starts, ends, seeds).tolist() == [zlib.crc32(b"17:" + data[a:b].tobytes()) for a, b in zip(starts, ends)]
