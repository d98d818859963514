import pytest

from starbeam.llm import token_counts as C
from starbeam.llm.queries import vocabulary

PATH = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def check(df, texts, library, **kw):
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in C.count_tokens(df, PATH, **kw).collect()), key=str)
    want = []
    for i, t in texts:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want, key=str)


TEXTS = [(1, None), (2, ""), (3, "  \n "), (4, "Hello, WORLD's end don't 123 45"), (5, "<|endoftext|>a <|startoftext|>"), (6, "ΣΑΣ İstanbul ǅ ﬁ é é  x\u0085y\x1cz"), (7, "a" * 30000), (8, "the cat " * 3000), (None, "null id"), (4, "Hello, WORLD's end don't 123 45"), (9, "<|ENDOFTEXT|>"), (10, "😀👩‍👩‍👧 中文字 ½²")]


@pytest.mark.parametrize("kw", [{}, {"frequent": 1}, {"cache": 1}])
def test_counts_equal_the_library(make_docs, library, kw):
    check(make_docs(TEXTS, clash=True), TEXTS, library, **kw)


def test_empty_table(make_docs):
    assert C.count_tokens(make_docs([]), PATH).count() == 0


def test_test_data(tables, library):
    docs = tables("documents")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()], library)


def test_frequent_runs_count_all_documents(make_docs):
    docs = make_docs([(i, "common words and rare%d" % i) for i in range(50)]).repartition(5)
    got = {bytes(r.run).decode(): r.n for r in C.frequent_runs(docs).collect()}
    assert got["common"] == got["words"] == 50 and not any(k.startswith("rare") for k in got)
