"""Conversations formatted and read back, against a version in plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from starload.llm import chat

MARKS = re.compile(r"<(?=(?:/?turn|says|part)>)")


def escape(s):
    return MARKS.sub("<\\\\", s.replace("\\", "\\\\"))


def by_hand(turns):
    """(formatted, texts of the assistant, blocks) of sorted (role, text) pairs."""
    out, blocks = "", 0
    for i, (role, text) in enumerate(turns):
        if i == 0 or turns[i - 1][0] != role:
            out, blocks = out + "<turn>" + escape(role) + "<says>", blocks + 1
        else:
            out += "<part>"
        out += escape(text)
        if i == len(turns) - 1 or turns[i + 1][0] != role:
            out += "</turn>\n"
    return out, "".join(t for r, t in turns if r == "assistant"), blocks


def sort_key(row):
    return (row[1] is not None, row[1] or 0, row[2] or "", row[3] or "")


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(3)
    odd = ["", "\\", "\\\\", "<turn>", "</turn>\n", "<\\turn>", "<\\\\turn>", "<part><part>", "<says>", "</tur", "<", "é😀</turn>", "a\nb", "</turn>", "\\### Assistant: </turn> ok", "<|end|>", "$1 \\1"]
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 12)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "us<says>er"]), "".join(rng.choice(odd) for _ in range(rng.randint(0, 4)))))
    rows += [(50, None, "user", "first"), (50, 0, None, None), (50, 0, "assistant", None), (50, -1, "user", "x")]  # nulls and a tie
    rows += [(51, 1, "assistant", "twice")] * 2 + [(51, 1, "user", "tie")]
    rows += [(52, i, rng.choice(["user", "assistant"]), f"turn {i} é") for i in range(1500)]  # longer than a stretch
    rows += [(53, 0, "user", "word " * 100000), (53, 1, "assistant", "<turn>" * 20000)]
    rng.shuffle(rows)
    return rows


def test_format_and_read_back(spark, conversations):
    schema = "conv_id long, turn long, role string, text string, id string, t int, ts string, blocks string"
    df = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in conversations], schema).repartition(5)
    made = chat.format_conversations(df)
    got = made.select("id", "formatted", "n_blocks", "loss_spans", chat.read_turns(F.col("formatted")).alias("turns"),
                      chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(got) == len({r[0] for r in conversations})
    for g in got:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in conversations if r[0] == g.id), key=sort_key)]
        formatted, loss, blocks = by_hand(turns)
        assert (g.formatted, g.loss, g.n_blocks) == (formatted, loss, blocks)
        assert [tuple(t) for t in g.turns] == turns
        raw = formatted.encode()
        assert [raw[s.start : s.start + s.length].decode() for s in g.loss_spans] == [escape(t) for r, t in turns if r == "assistant"]


def test_rows_without_a_conversation_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(None, 0, "user", "a"), (None, 0, "user", "a"), (None, 1, None, None)], schema)
    got = sorted((r.formatted, r.n_blocks) for r in chat.format_conversations(df).collect())
    assert got == [("<turn><says></turn>\n", 1), ("<turn>user<says>a</turn>\n", 1), ("<turn>user<says>a</turn>\n", 1)]
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0
