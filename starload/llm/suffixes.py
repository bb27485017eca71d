"""Repeated passages by a sparse suffix array.

Suffixes are kept at content-selected positions only: where the hash of ``ANCHOR`` words is the smallest of ``WINDOW``
consecutive ones.  Two occurrences of a passage select the same positions inside it, the first of them within WINDOW
words, so the suffixes there share the rest of the passage.  Suffixes are sorted by their first words (as a hash), then
by the words before, then by the words that follow; neighbours that share the first words are compared on the texts and
the match is extended to both sides.  A second sort, with the following words before the preceding ones, finds partners
that the first order puts apart; and each is compared with the earliest suffix that has the same first words.  Where three or more share their first
words, every run of ``MIN_RUN`` words there that lies in no span found so far is a key of its own: places that share it are
compared with the one before, so no passage is lost between strangers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import discard, hashed_together, leftmost_minima, materialize, ready, room, shingle_hashes, text_bytes, tidy
from starload.llm.passages import matched, merged_spans, neighbours, run_around

MIN_RUN, ANCHOR, WINDOW = 50, 8, 26
ROW = "key long, left long, right long, doc long, p long"


def _anchored(h: np.ndarray, bounds: np.ndarray, which: np.ndarray, left: np.ndarray, anchor: int, window: int, prefix: int) -> np.ndarray:
    """The selected positions of texts that lie one after the other; texts with fewer words than ``prefix`` have none."""
    a, whole = shingle_hashes(h, anchor), window + anchor - 1
    at = leftmost_minima(a, window) if len(a) >= window else np.empty(0, np.int64)
    p = at[left[: len(at)] >= whole]  # windows inside one text
    p = p[np.concatenate([np.ones(min(len(p), 1), bool), p[1:] != p[:-1]])]
    sizes = np.diff(bounds)
    few = [int(b + (a[b : b + n - anchor + 1].argmin() if n > anchor else 0)) for b, n in zip(bounds[:-1], sizes, strict=True) if prefix <= n < whole and n]
    p = np.sort(np.concatenate([p, np.array(few, np.int64)])) if few else p
    return p[(sizes[which[p]] >= prefix) & (left[p] >= prefix)]  # a suffix that is shorter than the prefix can't hold its share of a passage


def _suffixes(anchor: int, window: int, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[np.empty(0, np.int64)] for _ in range(5)]
            docs = batch.column(0).to_numpy()
            for index, h, bounds in hashed_together(batch.column(1).to_pylist()):
                if len(h) < prefix:
                    continue
                which, left_over = room(bounds)
                p = _anchored(h, bounds, which, left_over, anchor, window, prefix)
                runs, place = shingle_hashes(h, prefix), p - bounds[which[p]]
                left = np.where(place >= prefix, runs[np.maximum(p - prefix, 0)], np.uint64(0))
                right = np.where(left_over[p] >= 2 * prefix, runs[np.minimum(p + prefix, len(runs) - 1)], np.uint64(0))
                for at, x in zip(rows, (runs[p], left, right, docs[index[which[p]]], place), strict=True):
                    at.append(x.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in rows], names=["key", "left", "right", "doc", "p"])

    return run


def _windows(min_run: int, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every run of ``min_run`` words around a suffix' first words (a key and its place), but for those inside a span."""
        for batch in batches:
            rows = [[np.empty(0, np.int64)] for _ in range(3)]
            docs, places, spans = batch.column(0).to_numpy(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for index, h, bounds in hashed_together(batch.column(1).to_pylist()):
                if len(h) < min_run:
                    continue
                wanted = np.zeros(len(h), bool)
                for i, start, end in zip(index, bounds, bounds[1:], strict=False):
                    here = wanted[start : max(start, end - min_run + 1)]
                    for p in places[i]:
                        here[max(0, p - min_run + prefix) : p + 1] = True
                    for x in spans[i] or []:
                        here[x["start"] : max(x["start"], x["end"] - min_run + 1)] = False
                at, which = np.flatnonzero(wanted), room(bounds)[0]
                for column, x in zip(rows, (shingle_hashes(h, min_run)[at].view(np.int64), docs[index[which[at]]], at - bounds[which[at]]), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in rows], names=["key", "doc", "p"])

    return run


def _extended(min_run: int):
    def run(x: np.ndarray, y: np.ndarray, seeds: list[tuple[int, int]]) -> Iterator[tuple]:
        done: dict[int, int] = {}  # by diagonal: where the last match ends
        for i, j in seeds:
            if i >= len(x) or j >= len(y) or done.get(i - j, -1) > i:
                continue
            left, right = run_around(x, y, i, j)
            done[i - j] = i + right
            if left + right >= min_run:
                yield i - left, i + right, j - left, j + right, i, j

    return run


@tidy
def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN, anchor: int = ANCHOR,
                    window: int = WINDOW) -> DataFrame:
    """One row for each span of a document that occurs elsewhere, in another document or at another place: (id, start,
    end, repeat, other_id, other_start).

    [start, end) counts words and has at least ``min_run``; the passage of ``other_id`` from ``other_start`` on is equal,
    and can't be extended to either side.  ``repeat`` says that it stands earlier (by id, then position).

    Null and empty texts, texts of fewer than ``min_run`` words and rows with a null id have no spans; rows that share an
    id count as one document.  Texts are read whole; other columns are not looked at.
    """
    ready(docs.sparkSession)
    prefix = min_run - window + 1  # what is left of a passage behind its first anchor
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text")).where("id is not null and text is not null")
    rows = materialize(src.mapInArrow(_suffixes(anchor, window, prefix), ROW), "suffixes")
    one = materialize(neighbours(rows, ["key"], ["left", "right", "doc", "p"]), "one")
    shared = one.select(*[F.col(f"prev_{c}").alias(c) for c in rows.columns]).union(one.select(*rows.columns)).distinct()
    shared = materialize(shared, "shared")
    discard(rows)
    two = neighbours(shared, ["key"], ["right", "left", "doc", "p"])
    first = shared.groupBy("key").agg(F.min(F.struct("doc", "p")).alias("f"))
    three = shared.join(first, "key").select(F.col("f.doc").alias("a"), F.col("f.p").alias("pa"), F.col("doc").alias("b"), F.col("p").alias("pb"))
    ahead = F.struct("prev_doc", "prev_p") < F.struct("doc", "p")
    pick = lambda x, y: F.when(ahead, F.col(x)).otherwise(F.col(y))  # noqa: E731  the earlier one is a
    seeds = one.union(two).select(pick("prev_doc", "doc").alias("a"), pick("prev_p", "p").alias("pa"), pick("doc", "prev_doc").alias("b"), pick("p", "prev_p").alias("pb"))
    found = matched(seeds.union(three).where("a <> b or pa <> pb").distinct(), src, _extended(min_run))
    discard(one)
    # among three or more the partner may be none of those: runs that no earlier place was found for are compared whole
    many = shared.join(shared.groupBy("key").agg(F.count("*").alias("size")).where("size > 2").select("key"), "key", "left_semi")
    places = many.groupBy(F.col("doc").alias("id")).agg(F.collect_set("p").alias("places"))
    spans = found.groupBy(F.col("b").alias("id")).agg(F.collect_set(F.struct(F.col("start_b").alias("start"), F.col("end_b").alias("end"))).alias("spans"))
    wide = src.join(places, "id").join(spans, "id", "left").select("id", "text", "places", "spans")
    whole = materialize(wide.mapInArrow(_windows(min_run, prefix), "key long, doc long, p long"), "windows")
    last = neighbours(whole, ["key"], ["doc", "p"]).select(F.col("prev_doc").alias("a"), F.col("prev_p").alias("pa"), F.col("doc").alias("b"), F.col("p").alias("pb"))
    last = materialize(last.where("a <> b or pa <> pb").distinct(), "last")
    discard(whole)
    found = found.union(matched(last, src, _extended(min_run))).distinct()
    sides = found.select(F.col("b").alias("id"), F.col("start_b").alias("start"), F.col("end_b").alias("end"), F.lit(True).alias("repeat"), F.col("a").alias("other_id"), F.col("start_a").alias("other_start"))
    return sides.union(found.select("a", "start_a", "end_a", F.lit(False), "b", "start_b")).distinct()


def removals(spans: DataFrame) -> DataFrame:
    """(id, spans): what to cut out of each document so that every passage stays where it stands first."""
    return spans.where("repeat").groupBy("id").agg(merged_spans(F.collect_set(F.struct("start", "end"))).alias("spans"))
