import random
import re

import numpy as np
import pyarrow as pa
import pytest

from starbeam.llm import textscan as ts

from .conftest import ascii_lower

ALPHABET = list(" \t\n\x0b\x0cabZ09-_.é中😀\x00") + ["word", "  "]


def _texts(n=300, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 60))) for _ in range(n)] + [None, "", " ", "x" * 500]


@pytest.mark.parametrize("block", [1 << 17, 29, 5])
@pytest.mark.parametrize("table,fold,pattern", [(ts.NOT_SPACE, None, r"[^\x20\x09-\x0D]+"), (ts.ALNUM_OR_WIDE, ts.LOWER, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_match_the_pattern_in_any_block_size(monkeypatch, block, table, fold, pattern):
    monkeypatch.setattr(ts, "BLOCK", block)
    texts, seen = _texts(), {}
    for group in (64, 1 << 20):
        got, hashes = [], []
        for _, data, offsets in ts.text_groups(pa.record_batch({"text": pa.array(texts)}), "text", group):
            h, s, e = ts.scan_words(data, offsets[:-1], table, fold)
            row, raw = ts.rows_of(s, offsets), data.tobytes()
            for i in range(len(offsets) - 1):
                got.append([raw[x:y].decode() for x, y in zip(s[row[i] : row[i + 1]], e[row[i] : row[i + 1]])])
                hashes.append(h[row[i] : row[i + 1]])
        low = ascii_lower if fold is not None else str
        assert [[low(w) for w in ws] for ws in got] == [re.findall(pattern, low(t or "")) for t in texts]
        for ws, hs in zip(got, hashes):
            for w, h in zip(ws, hs):
                assert seen.setdefault(low(w), h) == h
    assert len(set(map(int, seen.values()))) == len(seen)


def test_hash_table_finds_all_and_only_its_keys():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    table = ts.HashTable(keys, np.arange(5000))
    assert (table.get(keys) == np.arange(5000)).all()
    assert (table.get(keys + np.uint64(1)) == -1).all()
    assert (ts.HashTable(keys[:0], []).get(keys) == -1).all()
    assert ts.HashTable(np.zeros(1, np.uint64), [7]).get(np.zeros(2, np.uint64)).tolist() == [7, 7]


def test_sliced_columns_and_nulls():
    column = pa.array(["skip", None, "ab", ""]).slice(1)
    data, offsets = ts.flat_text(column)
    assert data.tobytes() == b"ab" and offsets.tolist() == [0, 0, 2, 2]


@pytest.mark.parametrize("bits", [10, 11, 12])
def test_thue_morse_words_do_not_collide(bits):
    """A sum over positions modulo 2^64 gives the word and its complement one hash, whatever the base."""
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(1 << bits))
    other = word.translate(str.maketrans("ab", "ba"))
    data = np.frombuffer((word + other).encode(), np.uint8)
    n = len(word)
    for size in (n, 64, 128):
        h = ts.range_hashes(data, np.array([0, n]), np.array([size, n + size]))
        assert h[0] != h[1]
