import random

import pytest
from prose import prose


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): null and empty texts, null ids, repeated rows, ties, a very long text, copies, near copies, shared
    passages, odd characters."""
    rng = random.Random(7)
    base = prose(rng, 300)
    near = base.copy()
    near[100] = "changed"
    shared = prose(rng, 60)
    rows = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one"), (6, "ONE"), (7, "two words"),
        (10, " ".join(base)), (11, " ".join(base)), (12, " ".join(near)), (13, " ".join(base)),
        (20, " ".join(prose(rng, 80) + shared + prose(rng, 90))), (21, " ".join(prose(rng, 120) + shared + prose(rng, 40))),
        (22, "\n".join([" ".join(prose(rng, 70)), " ".join(shared), " ".join(prose(rng, 30))])),
        (30, "é É ß x y \x0b\x0c\r\n z\x00z 你好 😀 it's <|endoftext|> don't  stop"),
        (31, "same line\nsame line\n\nsame line \nother"), (32, "a b c a b c a b c x a b c"),
        (40, " ".join(prose(rng, 20000))), (41, "x" * 50000),
        (None, " ".join(prose(rng, 60))), (None, None), (50, " ".join(prose(rng, 55))), (50, " ".join(prose(rng, 55))),
    ]
    return rows + [(60, "repeated row of a few words")] * 2 + [(100 + i, " ".join(prose(rng, rng.randint(1, 200)))) for i in range(30)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows as documents, with more columns whose names the operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, id long, node long, key long, a string, b string, n int, h long, spans string, text_hash string, ws string"
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 1, 1, "a", "b", 1, 1, "x", "y", "z") for i, t in edge_rows], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
