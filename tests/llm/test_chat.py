import random

import numpy as np
import pytest

from starbeam.llm import chat
from starbeam.llm.queries import vocabulary

from .conftest import sha

PATH = vocabulary("byte_bpe_50k.json")
ROWS = "conv_id long, turn long, role string, text string"
PARTS = [*chat.CONTROL, "<", "[", "/INST]", "\\", "s>", " ", "  ", "\n", "a", "é", "😀", "中", "<|endoftext|>", "it's"]


def test_escape_and_parse_are_exact_and_the_mask_covers_each_text_once():
    rnd = random.Random(3)
    encoder = chat.make_encoder(open(PATH, "rb").read())
    for _ in range(3000):
        turns = [(rnd.choice(["user", "assistant", "assistant", "system", "tool", "", "[TEXT]", "</s>"]), "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 9)))) for _ in range(rnd.randint(0, 5))]
        text, spans = chat.render(turns)
        assert chat.parse(text) == turns
        offsets = np.array(encoder.encode(text, add_special_tokens=False).offsets).reshape(-1, 2)
        mask, ranges = chat.loss_mask(offsets, spans, [r for r, _ in turns])
        assert chat.masked_text(text, offsets, ranges) == [t for r, t in turns if r == "assistant"]
        assert mask.sum() == sum(b - a for a, b in ranges)


def expected(rows):
    convs = {}
    for c, n, r, t in rows:
        convs.setdefault(c, []).append((n if n is not None else -1, r or "", t or ""))
    out = []
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss)))
    return sorted(out, key=str)


CONTROL = "</s>[INST] ok [/INST]"
CASES = [
    (-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL), (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (2, None, "assistant", "null turn first"), (3, 0, "assistant", ""), (3, 0, "assistant", "tie"),
    (None, 0, "user", "no id"), (4, 0, "assistant", "long " * 40000), (4, 0, "assistant", "long " * 40000), (5, 0, "weird [ROLE]", "x\\"), (5, 1, "assistant", "  lead and trail \n"),
]


@pytest.mark.parametrize("clash", [False, True])
def test_digests_read_back(spark, clash):
    df = spark.createDataFrame(CASES, ROWS)
    if clash:
        df = df.selectExpr("*", "'x' AS turns", "'y' AS formatted", "1 AS loss_mask")
    got = chat.read_back(chat.format_conversations(df, PATH)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(CASES)


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], ROWS), PATH)).count() == 0


def test_test_data(tables):
    rows = tables("conversations")
    got = chat.read_back(chat.format_conversations(rows, PATH)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected([(r.conv_id, r.turn, r.role, r.text) for r in rows.collect()])
