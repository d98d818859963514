import random

import pytest

import corpus_pipeline
from starbeam.llm import queries

from .conftest import CLASHES


def _words(rnd, n):
    return " ".join("".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean, toxic, copied, nearly copied and contaminated documents, and what must become of them."""
    rnd, rows, labels, fate = random.Random(4), [], [], {}
    item = _words(rnd, 30)
    for i in range(300):
        text = _words(rnd, rnd.randint(40, 150))
        toxic = i % 6 == 0
        if toxic:
            parts = text.split()
            for w in ("zorgnik", "plimfax", "grubbel"):
                parts.insert(rnd.randrange(len(parts)), w)
            text = " ".join(parts)
        rows.append((i, text))
        labels.append((i, 1, int(toxic)))
        fate[i] = "toxic" if toxic else "kept"
    clean = [i for i in range(300) if fate[i] == "kept"]
    texts = dict(rows)
    for k, i in enumerate(clean[:20]):  # exact copies: the largest id stays
        rows.append((1000 + k, texts[i]))
        fate[1000 + k], fate[i] = "kept", "copy"
    for k, i in enumerate(clean[20:40]):  # near copies: the smallest id stays
        rows.append((2000 + k, texts[i] + " oneword"))
        fate[2000 + k] = "near"
    for k in range(10):
        rows.append((3000 + k, _words(rnd, 20) + " " + " ".join(item.split()[5:20]) + " " + _words(rnd, 20)))
        fate[3000 + k] = "leak"
    rows += [(4000, None), (4001, "")]  # equal after null counts as empty
    fate[4000], fate[4001] = "copy", "kept"
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHES]).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, fate


def test_stages_take_effect_in_order(spark, corpus, tmp_path):
    folder, fate = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    gone = {"toxicity": "toxic", "exact_dedup": "copy", "near_dedup": "near", "decontamination": "leak"}
    left = set(fate)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if name in gone:
            left -= {i for i, f in fate.items() if f == gone[name]}
            assert docs.columns == columns
        assert {r.doc_id for r in docs.select("doc_id").collect()} == left, name
    assert {"n_tokens", "ids", "ids_sha256", "decoded_sha256"} <= set(docs.columns)
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).select("doc_id").collect()} == left


def test_stage_names_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "byte_bpe"]
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))


def test_empty_corpus(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rows_not_ids_are_dropped(spark, make_docs, tmp_path):
    """Null ids, and ids repeated over different texts: no clean row goes, no copy or passage stays."""
    rnd = random.Random(8)
    item, other, clean, leak = _words(rnd, 30), _words(rnd, 60), _words(rnd, 60), _words(rnd, 20)
    leak = f"{leak} {item} {leak}"
    docs = make_docs([(1, other), (2, other), (2, clean), (None, other + " end"), (None, clean + " end"), (7, leak), (7, "calm words"), (None, leak + " x"), (None, "calm too")], clash=True)
    near = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert near.columns == docs.columns
    kept = sorted((str(r.doc_id), r.text) for r in near.collect())
    assert kept == sorted([("1", other), ("2", clean), ("7", leak), ("7", "calm words"), ("None", "calm too")])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == sorted((str(r.doc_id), r.text) for r in docs.collect() if item not in r.text)
