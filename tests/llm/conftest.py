import hashlib
import re

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; further columns of the same names must not disturb them.
CLASHES = ("id", "key", "hash", "row", "n", "m", "kept", "kept_id", "kept_sha", "gone_id", "hit_id", "recipe", "bands", "component", "score", "predicted", "n_words", "text_class", "windows", "label", "toxic")


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group(0).lower(), text)


@pytest.fixture
def make_docs(spark):
    """Documents table from (id, text) pairs; ``clash`` adds columns with names used inside the operators."""

    def make(pairs, clash=False):
        df = spark.createDataFrame([(i, t, "en", "src", None) for i, t in pairs], DOCS)
        if clash:
            for name in CLASHES:
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def tables(spark, sf_small):
    def read(name):
        return spark.read.parquet(f"{sf_small}/{name}.parquet")

    return read
