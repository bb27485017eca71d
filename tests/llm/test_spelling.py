"""Spelling variants against brute force."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from starload.llm import spelling


def by_hand(rows):
    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, forms = {}, {}
    for w in n:
        others = sorted((-n[v], v) for v in n if near(w, v))
        best = others[0] if others and -others[0][0] >= 2 * n[w] else None
        out[w] = [w, best and best[1], w, n[w], len(others), best and -best[0]]
        forms[w] = best and best[1]
    for w, row in out.items():
        while forms[row[2]]:
            row[2] = forms[row[2]]
    return sorted(map(tuple, out.values()))


def found(spark, rows):
    schema = "doc_id long, text string, word string, n long, edit string, id int"
    df = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], schema).repartition(3)
    return sorted(tuple(r) for r in spelling.spelling_variants(df).collect())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(60)] + ["zzzzz", "zzzzzz", "ÀÖÿ×÷", "Straße", "straßen"]
    rows = []
    for i in range(150):
        ws = [rng.choice(base[: rng.randint(1, len(base))]) for _ in range(rng.randint(0, 60))]
        ws = [w if rng.random() < 0.8 else w[: (k := rng.randrange(len(w)))] + rng.choice(["", "x", w[k] + w[k]]) + w[k + 1 :] for w in ws]
        rows.append((i * 13, rng.choice([" ", ", ", "\n", "-1-"]).join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in ws)))
    long_word = "".join(rng.choice("abcd") for _ in range(3000))
    rows += [(5000 + i, f"{long_word} {long_word[:1500]}{'b' if long_word[1500] != 'b' else 'c'}{long_word[1501:]} {long_word[1:]}") for i in range(4)]
    rows += [(None, "null words null words null words"), (None, None), (1, None), (2, ""), (3, "你好 123"), (3, "words words"), (3, "words words")]
    return rows + [(7000 + i, "lonely " * 3 + "chain " * 2**i) for i in range(3)] + [(8000, "chaim " * 3 + "chaimm " * 3 + "w" * 50000)]


def test_against_brute_force(spark, texts):
    got, want = found(spark, texts), by_hand(texts)
    assert got == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] not in (r[0], r[1]) for r in want)


def test_small_filters_only_let_more_through(spark, texts, monkeypatch):
    monkeypatch.setattr(spelling, "FILTER_BITS", 512)
    monkeypatch.setattr(spelling, "EDITED", 50)
    monkeypatch.setattr(spelling, "COUNTED", 40)
    assert found(spark, texts) == by_hand(texts)


def test_no_words(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, "a b c 1 2"), (3, "once twice")]) == []


def test_hash_of_an_edit_follows_from_the_word():
    word = b"abc\xe9fgh"
    code, p = spelling._letters([word]), spelling.powers(20)
    whole = (code[0] * p[: len(word)]).sum(dtype=np.uint64)
    for i in range(len(word)):
        shorter = word[:i] + word[i + 1 :]
        before = (code[:, :i] * p[:i]).sum(axis=1, dtype=np.uint64)
        want = (spelling._letters([shorter])[0] * p[: len(shorter)]).sum(dtype=np.uint64)
        assert (before + (whole - before - code[:, i] * p[i]) * spelling.BACK == want).all()
