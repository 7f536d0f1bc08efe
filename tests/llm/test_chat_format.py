import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tablelog.llm import chat_format

PARTS = ["<|im_end|>", "<|im_start|>", "\n", "<|im_end|>\n", "<|im_start|>assistant\n", "<|", "<\\|", "<\\\\|im_end|>", "\\", "|>", "<|nl|>", "hello", "é☃", "$1", " "]


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(8)
    rows = []
    for c in range(200):
        for t in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", None, "a\nb", "<|im_end|>", "x<|nl|>y"] if c % 4 == 0 else ["user", "assistant"])
            text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8))) if c % 2 else "plain words\nof two lines"
            rows.append((c, t, role, text if rng.random() > 0.1 else None))
    rows += [(None, 1, "user", "a"), (None, 0, "assistant", "b"), (500, None, "user", "first"), (500, 1, "user", "z"), (500, 1, "assistant", "y"), (501, 1, "user", "same"), (501, 1, "user", "same")]
    return rows + [(502, i, "assistant", "long " * 5000) for i in range(3)]


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("turns", "level", "good", "loss")})


def source(rows):
    out = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    return out


def test_reads_back(spark, turns):
    df = chat_format.format_conversations(table(spark, turns)).withColumn("back", chat_format.parsed(F.col("formatted")))
    got = df.withColumn("learned", chat_format.loss_text(F.col("formatted"), F.col("loss"))).collect()
    want = source(turns)
    assert len(got) == len(want)
    levels = set()
    for r in got:
        assert [(t["role"], t["text"]) for t in r["back"]] == want[r["conv_id"]]
        assert r["learned"] == "".join(x for role, x in want[r["conv_id"]] if role == "assistant")
        assert len(r["loss"]) == sum(role == "assistant" for role, _ in want[r["conv_id"]])
        assert len(re.findall(r"<\|im_(?:start|end)\|>", r["formatted"])) == 2 * len(want[r["conv_id"]])
        levels.add(r["level"])
    assert levels == {0, 1, 2}


def test_plain_text_is_not_escaped(spark):
    rows = [(1, 0, "user", "if a <| b or a |> b"), (1, 1, "assistant", "yes")]
    got = chat_format.format_conversations(table(spark, rows)).first()
    assert got["level"] == 0
    assert got["formatted"] == "<|im_start|>user\nif a <| b or a |> b<|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n"


def test_empty_and_native(spark, turns):
    df = chat_format.format_conversations(table(spark, turns))
    assert not re.search("Python|Pandas|MapInArrow", df._jdf.queryExecution().toString())
    assert chat_format.format_conversations(table(spark, turns).filter("false")).count() == 0
