"""Passages that two texts share: content-selected positions, matching from a common seed, and cutting spans out.

Positions count words (runs of anything but ASCII white space) from 0; spans are [start, end).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.common import fresh, hashed_together, leftmost_minima, materialize, mixed

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
MATCH = ["a", "b", "start_a", "end_a", "start_b", "end_b", "seed_a", "seed_b"]


def breaks(h: np.ndarray, bounds: np.ndarray, left: np.ndarray, reach: int) -> np.ndarray:
    """Where content-defined paragraphs begin in texts that lie one after the other (``left`` words of the text from each word on):
    at their first words, and at every position whose hash is the smallest within ``reach`` words of the text."""
    wide = 2 * reach + 1
    x = mixed(h[:-1] * np.uint64(3) + h[1:])
    at = leftmost_minima(x, wide) if len(x) >= wide else np.empty(0, np.int64)
    lowest = np.flatnonzero((at == np.arange(len(at)) + reach) & (left[: len(at)] > wide))
    return np.unique(np.concatenate([bounds[:-1][np.diff(bounds) > 0], lowest + reach]))


def run_around(x: np.ndarray, y: np.ndarray, i: int, j: int) -> tuple[int, int]:
    """The longest run of equal words through positions i of x and j of y: words to the left, and to the right with it."""
    def equal(u: np.ndarray, v: np.ndarray) -> int:
        n, done, step = min(len(u), len(v)), 0, 64
        while done < n:
            same = u[done : done + step] == v[done : min(done + step, n)] if done + step <= n else u[done:n] == v[done:n]
            if not same.all():
                return done + int(same.argmin())
            done, step = done + len(same), step * 2
        return n

    return equal(x[:i][::-1], y[:j][::-1]), equal(x[i:], y[j:])


def matched(pairs: DataFrame, docs: DataFrame, compare) -> DataFrame:
    """What ``compare`` finds for each pair of documents; ``pairs(a, pa, b, pb)`` names seeds, ``docs(id, text)`` texts.

    The seeds of two documents are gathered first (one document has a bounded number of seeds), so two texts are brought
    together once.  ``compare(x, y, seeds)`` gets word hashes and yields (start_a, end_a, start_b, end_b, seed_a, seed_b).
    """
    seeds = materialize(pairs.groupBy("a", "b").agg(F.collect_set(F.struct("pa", "pb")).alias("seeds")), "seeds")
    wanted = seeds.select(F.col("a").alias("id")).union(seeds.select(F.col("b").alias("id"))).distinct()
    texts = docs.join(wanted, "id", "left_semi").select("id", "text")
    both = seeds.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, seeds, ta, tb = (batch.column(i).to_pylist() for i in range(5))
            texts = list(dict.fromkeys([*tb, *ta]))  # a text is in many pairs
            known = {texts[i]: h[start:end] for index, h, bounds in hashed_together(texts) for i, start, end in zip(index, bounds, bounds[1:], strict=False)}
            rows = []
            for x, y, s, u, v in zip(a, b, seeds, ta, tb, strict=True):
                rows += [(x, y, *map(int, f)) for f in compare(known[u], known[v], sorted((k["pa"], k["pb"]) for k in s))]
            columns = zip(*rows, strict=True) if rows else [[]] * len(MATCH)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=MATCH)

    return materialize(both.select("a", "b", "seeds", "ta", "tb").mapInArrow(run, ", ".join(f"{c} long" for c in MATCH)), "matches")


def neighbours(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Pairs of rows that follow each other in the order of ``key`` and ``order`` and have the same ``key``: the earlier
    row's columns are named ``prev_*``.  All columns are non-null longs.

    The rows are sorted over all tasks by ranges of the whole order, so many rows of one key are spread over tasks; the
    rows at the borders of the tasks, two of each, are compared in a second step.
    """
    names = rows.columns
    out = [f"prev_{c}" for c in names] + names + ["part", "border"]
    n_key = [names.index(c) for c in key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None

        def made(prev: np.ndarray, now: np.ndarray, border: int) -> pa.RecordBatch:
            fixed = [np.full(now.shape[1], part, np.int64), np.full(now.shape[1], border, np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in [*prev, *now, *fixed]], names=out)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            now = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if last is None:
                yield made(now[:, :1], now[:, :1], 1)
            else:
                now = np.concatenate([last, now], axis=1)
            same = np.logical_and.reduce([now[i, 1:] == now[i, :-1] for i in n_key])
            yield made(now[:, :-1][:, same], now[:, 1:][:, same], 0)
            last = now[:, -1:]
        if last is not None:
            yield made(last, last, 2)

    by = [*key, *order]
    spread = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    found = materialize(spread.mapInArrow(run, ", ".join(f"{c} long" for c in out)), "neighbours")
    both = [f"prev_{c}" for c in names] + names
    before = Window.orderBy("part", "border")  # two rows of each task
    ends = found.where("border > 0").withColumns({f"prev_{c}": F.lag(c).over(before) for c in names})
    ends = ends.where("border = 1 and " + " and ".join(f"prev_{c} = {c}" for c in key))
    return found.where("border = 0").select(both).union(ends.select(both))


def merged_spans(spans: Column) -> Column:
    """Spans (an array of structs start, end) without overlaps, in order."""
    kind = "array<struct<start:bigint,end:bigint>>"
    none = F.array().cast(kind)

    def add(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        touch = (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] >= s["start"])
        return F.when(touch, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined)).cast(kind)).otherwise(F.concat(acc, F.array(s)).cast(kind))

    return F.aggregate(F.sort_array(spans), none, add)


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans; white space after a span goes with it, as far as words are left."""
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, done = [], 0
    for start, end in spans:
        start, end = min(start, len(at) - 1), min(end, len(at) - 1)
        out.append(text[done : at[start]])
        done = at[end]
    out.append(text[done:])
    return b"".join(out)


def without_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the word spans of ``spans(id, spans)`` cut out of the texts; documents without spans as they are."""
    key, cuts = fresh(docs, "span_id"), fresh(docs, "span_list")
    keyed = docs.join(spans.select(F.col("id").alias(key), F.col("spans").alias(cuts)), F.col(id_col) == F.col(key), "left").drop(key)
    at, width = docs.columns.index(text_col), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(width)]
            texts, found = columns[at].to_pylist(), batch.column(width).to_pylist()
            if any(found):
                new = [cut(t.encode(), [(x["start"], x["end"]) for x in f]).decode() if t and f else t for t, f in zip(texts, found, strict=True)]
                columns[at] = pa.array(new, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:width])

    return keyed.mapInArrow(run, docs.schema)
