import hashlib
import random
import struct

import numpy as np
import pytest

from starbeam.llm import bpe
from starbeam.llm.queries import vocabulary

from .conftest import sha

PATH = vocabulary("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(open(PATH, "rb").read())


@pytest.fixture(scope="module")
def reference(ranks):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [(1, None), (2, ""), (3, " "), (4, "it's they'RE we'll I'd 'sand ''s 5's"), (5, "<|endoftext|> x"), (6, "a" * 3000 + " " * 300), (7, "\n\n\n x \t\ty  "), (8, "é😀 ½² 中文"), (None, "null"), (4, "it's they'RE we'll I'd 'sand ''s 5's"), (9, "ab" * 300 + "\x85\xa0z")]


@pytest.mark.parametrize("clash", [False, True])
def test_rows_equal_the_library(make_docs, reference, clash):
    got = {(r.doc_id, r.n_tokens, tuple(r.ids), r.ids_sha256, r.decoded_sha256) for r in bpe.encode_texts(make_docs(TEXTS, clash), PATH).collect()}
    want = set()
    for i, t in TEXTS:
        ids = reference.encode_ordinary(t or "")
        want.add((i, len(ids), tuple(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(t or "")))
    assert got == want
    assert bpe.encode_texts(make_docs([]), PATH).count() == 0


def test_random_texts_and_a_small_cache(ranks, reference):
    rnd = random.Random(11)
    alphabet = list("  \n\t'’stmdrevlLR019½²éñ😀中  \x85_#-!") + ["'s", "'re", "'ll", " '", "abab", "aaaa"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    encoder = bpe.Encoder(ranks, cache=50)
    for a in range(0, len(texts), 500):
        part = [t.encode() for t in texts[a : a + 500]]
        ids, row = encoder.encode(np.frombuffer(b"".join(part), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in part])]))
        for t, p, x, y in zip(texts[a : a + 500], part, row[:-1], row[1:]):
            assert ids[x:y].tolist() == reference.encode_ordinary(t)
            assert encoder.decode(ids[x:y]) == p


def test_matrix_and_heap_agree(ranks, reference):
    merger, rnd = bpe.Merger(ranks), random.Random(4)
    pieces = ["".join(rnd.choice("abcdeth") for _ in range(rnd.randint(1, bpe.LONGEST_ROW))).encode() for _ in range(300)]
    ids, sizes = merger.matrix(pieces, bpe.LONGEST_ROW)
    for p, x in zip(pieces, np.split(ids, np.cumsum(sizes)[:-1])):
        assert x.tolist() == merger.heap(p).tolist()


def test_test_data(tables, reference):
    docs = tables("documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in bpe.encode_texts(docs, PATH, keep_ids=False).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == sha(texts[r.doc_id])
