"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starload.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id long, row string, block int, score double"


def by_hand(rows, positives=5, count=10, low=30, high=90):
    ok = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            ok[(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v))] = None
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731 - a shorter vector is filled with zeros
    for a in ok:
        if a[0] % 10:
            continue
        scored = [(-dot(a[2], b[2]), b[0], b[1]) for b in ok if b != a]
        for p, pid, _ in sorted(s for s in scored if s[2] == a[1])[:positives]:
            inside = sorted(s for s in scored if s[2] != a[1] and low * -p <= 100 * -s[0] <= high * -p)
            out += [(a[0], pid, r, nid, -p, -n) for r, (n, nid, _) in enumerate(inside[:count], 1)]
    return sorted(out)


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x", 2, 0.5) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, **kw).collect())


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 12))
    rows = []
    for i in range(500):
        v = centres[i % 4] + rng.normal(size=12)
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(rng.integers(0, 3))))
    one = rows[7][1]
    rows += [(600 + i, one, i % 2) for i in range(150)]  # a vector that many rows have
    rows += [rows[20], rows[20], (21, rows[30][1], 1)]  # repeated rows, and a key with two vectors
    rows += [(700, None, 1), (710, [None, 1.0], 1), (720, [float("nan")] * 12, 1), (730, [float("inf")] * 12, 1), (740, [0.5] * 12, None), (None, one, 1)]
    return rows + [(750, [], 0), (760, [0.25] * 5, 2), (770, [0.0] * 12, 2)]


def test_against_brute_force(spark, vectors, monkeypatch):
    want = by_hand(vectors)
    assert len(want) > 1000
    assert found(spark, vectors) == want
    # many small blocks and groups, so that windows are filled over cells
    monkeypatch.setattr(negatives, "GRAIN", 2)
    monkeypatch.setattr(negatives, "GROUP", 16)
    monkeypatch.setattr(negatives, "FIRST", 4)
    monkeypatch.setattr(negatives, "SLICE", 7)
    assert found(spark, vectors) == want


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4) * 2.0**19], i % 3) for i in range(40)]
    assert found(spark, rows) == by_hand(rows)


def test_no_rows_and_no_anchors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []
    assert found(spark, [(10, [1.0], 1), (2, [-1.0], 1), (3, [1.0], 2)]) == []  # the positive's score is below zero


def test_pairs_above_finds_what_a_product_finds():
    rng = np.random.default_rng(7)
    for scale, width in ((1, 64), (40, 20), (5, 3)):
        q, x = (np.floor(rng.normal(size=(n, width)) * 256 / scale * rng.random((1, width)) ** 3) for n in (9, 300))
        full = q @ x.T
        for share in (0.1, 0.5, 0.9, 0.99):
            floor = np.quantile(full, share, axis=1).round()
            i, j, s = negatives.pairs_above(q, x, floor)
            wi, wj = np.nonzero(full >= floor[:, None])
            assert sorted(zip(i, j, s)) == sorted(zip(wi, wj, full[wi, wj]))
