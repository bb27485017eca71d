"""Repeated passages by MinHash banding of content-defined paragraphs.

Line breaks don't show where a copied passage begins, so a paragraph is a stretch of words between content-defined breaks
(where the hash of two words is the smallest within ``REACH`` words): texts that share a passage share its paragraphs, but
for those at its ends.  Six bands hold two minima each, which gives high recall: two paragraphs of similarity 0.8 meet in one
of them with probability 0.998, of 0.5 (the ends of a passage) with 0.82.

Paragraphs that collide are joined and verified on the texts: the run of equal words through the shingle that made them collide
is followed over small differences (words replaced, inserted or left out) to both sides, and what comes out must be long
enough and have a high enough exact Jaccard similarity on five-word shingles.  Verified pairs are clustered by connected
components.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import discard, hashed_together, materialize, mixed, ready, room, shingle_hashes, text_bytes, tidy
from starload.llm.components import connected_components
from starload.llm.passages import breaks, matched, merged_spans, neighbours, run_around

REACH, BANDS, ROWS, SHINGLE = 10, 6, 2, 5
#: Words of a passage, whatever surrounds it.
MIN_RUN = 50


ENTRY = "key long, id long, p long, again long"
#: Behind the place of a band key lie 16 bits for the words from it on and 16 for the words before it, 0 if the text has not so many.
SIDE = 16


def _distinct(which: np.ndarray, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every key of a text and its place once, ordered by all three; and 1 for each key that the text has at an earlier place as well."""
    keys = keys.view(np.int64)
    order = np.lexsort((places, keys, which))
    which, keys, places = which[order], keys[order], places[order]
    new, again = np.ones(len(keys), bool), np.zeros(len(keys), bool)
    again[1:] = (which[1:] == which[:-1]) & (keys[1:] == keys[:-1])
    new[1:] = ~again[1:] | (places[1:] != places[:-1])
    return which[new], keys[new], places[new], again[new].astype(np.int64)


def _sides(h: np.ndarray, bounds: np.ndarray, which: np.ndarray, left: np.ndarray, p: np.ndarray, least: int) -> np.ndarray:
    """Places p and short hashes of the words on both sides.  Of ``least`` equal words around two places one half at least lies behind
    them (with the words there) or before them, so where both halves differ the run is shorter."""
    after, place = -(-least // 2), p - bounds[which[p]]
    before = least - after + 1
    out = place.astype(np.int64) << 2 * SIDE
    runs = {n: shingle_hashes(h, n) for n in {after, before}}
    for n, at, fits, shift in ((after, p, left[p] >= after, SIDE), (before, p - before, place >= before, 0)):
        out[fits] |= (runs[n][at[fits]] % np.uint64((1 << SIDE) - 1) + np.uint64(1)).astype(np.int64) << shift
    return out


def _place(p: Column) -> Column:
    return F.shiftright(p, 2 * SIDE)


def _may_run(p: Column, q: Column) -> Column:
    """Whether two places of :func:`_sides` have the same words on one side."""
    def same(shift: int) -> Column:
        u, v = (F.shiftright(x, shift).bitwiseAND((1 << SIDE) - 1) for x in (p, q))
        return (u == v) & (u != 0)

    return same(SIDE) | same(0)


def _bands(reach: int, bands: int, rows: int, shingle: int, least: int):
    seeds = mixed(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)

    def keys_of(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Band keys of the paragraphs of texts that lie one after the other, and the words where the shingles lie that made them:
        (text, key, place with its sides, again), ordered by all three."""
        which, left = room(bounds)
        s = shingle_hashes(h, shingle)
        inside = np.flatnonzero(left[: len(s)] >= shingle)
        starts = breaks(h, bounds, left, reach)
        starts = np.searchsorted(inside, starts[left[starts] >= shingle])  # a shingle belongs to the paragraph where it begins
        s, lengths = s[inside], np.diff(np.append(starts, len(inside)))
        paragraph = np.repeat(np.arange(len(starts)), lengths)
        keys, places = [], []
        for t in range(bands):
            x = s * seeds[t * rows]
            low = np.minimum.reduceat(x, starts)
            first = np.flatnonzero(x == low[paragraph])
            first = first[np.diff(paragraph[first], prepend=-1) > 0]  # leftmost in each paragraph
            for r in range(1, rows):
                low = mixed(low) + np.minimum.reduceat(s * seeds[t * rows + r], starts)
            keys.append(mixed(low + np.uint64(t)))
            places.append(inside[first])
        places = np.concatenate(places)
        return _distinct(which[places], np.concatenate(keys), _sides(h, bounds, which, left, places, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[np.empty(0, np.int64)] for _ in range(4)]
            ids = batch.column(0).to_numpy()
            for index, h, bounds in hashed_together(batch.column(1).to_pylist()):
                if np.diff(bounds).max() < shingle:
                    continue
                which, k, p, again = keys_of(h, bounds)
                for at, x in zip(rows, (k, ids[index[which]], p, again), strict=True):
                    at.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in rows], names=["key", "id", "p", "again"])

    return run


def _leaves(x: np.ndarray, y: np.ndarray, i: int, j: int, start: int, end: int) -> bool:
    """Whether the words beside y's span [start, end) may belong to the run through i of x and j of y."""
    before, after = i - (j - start) - 1, i + end - j
    return (start > 0 and before >= 0 and x[before] == y[start - 1]) or (end < len(y) and after < len(x) and x[after] == y[end])


#: A region goes on behind a difference if so many words are equal there, at most so many words further on either side.
RESUME, JUMP = 5, 3
_JUMPS = sorted(((a, b) for a in range(JUMP + 1) for b in range(JUMP + 1) if a or b), key=lambda j: (j[0] + j[1], abs(j[0] - j[1]), j))


def _onward(x: np.ndarray, y: np.ndarray, i: int, j: int) -> tuple[int, int]:
    """From words i of x and j of y, which differ, over small differences to where equal words end for good: words of both."""
    m = n = 0
    while True:
        for a, b in _JUMPS:
            u, v = x[i + m + a : i + m + a + RESUME], y[j + n + b : j + n + b + RESUME]
            if len(u) == len(v) == RESUME and (u == v).all():
                run = run_around(x[i + m + a :], y[j + n + b :], 0, 0)[1]
                m, n = m + a + run, n + b + run
                break
        else:
            return m, n


def region(x: np.ndarray, y: np.ndarray, i: int, j: int, left: int, right: int) -> tuple[int, int, int, int]:
    """The run around words i of x and j of y (``left`` words before them and ``right`` from them on) and what follows on both
    sides behind replaced, inserted or missing words: [start, end) of x and of y."""
    m, n = _onward(x, y, i + right, j + right)
    p, q = _onward(x[: i - left][::-1], y[: j - left][::-1], 0, 0)
    return i - left - p, i + right + m, j - left - q, j + right + n


def _similar(x: np.ndarray, y: np.ndarray, shingle: int, percent: int) -> bool:
    u, v = np.unique(shingle_hashes(x, shingle)), np.unique(shingle_hashes(y, shingle))
    both = len(np.intersect1d(u, v, assume_unique=True))
    return 100 * both >= percent * (len(u) + len(v) - both)


def least_run(min_run: int, shingle: int, percent: int) -> int:
    """Equal words in a row that two regions of ``min_run`` words or more must share somewhere if their Jaccard similarity is
    ``percent``: a difference costs ``shingle`` shingles of both, so there can be only so many, and they cut the region into
    pieces of which one has this many words at least."""
    best = min_run
    for changes in range(1, 200):
        # the least shingles with which (s - shingle * changes) / (s + shingle * changes) reaches the similarity
        s = -(-shingle * changes * (100 + percent) // (100 - percent)) if percent < 100 else 1 << 60
        words = max(min_run, s + shingle - 1)
        best = min(best, -(-(words - changes) // (changes + 1)))
    return best


def _compare(shingle: int, percent: int, min_run: int):
    least = least_run(min_run, shingle, percent)

    def run(x: np.ndarray, y: np.ndarray, seeds: list[tuple[int, int]]) -> Iterator[tuple]:
        """Passages around the seeds: the run of equal words, with what follows behind small differences if the whole is similar
        enough, else the run alone if it is long enough.  A seed inside a run that was looked at is part of it, and one whose run
        can't leave a span of y that was found already adds nothing."""
        done: dict[int, int] = {}  # by diagonal: where the last run ends
        spans: list[tuple[int, int]] = []  # of y, in order
        for i, j in seeds:
            if i >= len(x) or j >= len(y) or done.get(i - j, -1) > i:
                continue
            at = bisect_right(spans, (j, len(y))) - 1
            if at >= 0 and spans[at][1] > j and not _leaves(x, y, i, j, *spans[at]):
                continue
            left, right = run_around(x, y, i, j)
            done[i - j] = i + right
            if left + right < least:
                continue
            a, b, c, d = region(x, y, i, j, left, right)
            if (b - a, d - c) != (left + right, left + right) and (min(b - a, d - c) < min_run or not _similar(x[a:b], y[c:d], shingle, percent)):
                a, b, c, d = i - left, i + right, j - left, j + right
            if min(b - a, d - c) >= min_run:
                insort(spans, (c, d))
                yield a, b, c, d, i, j

    return run


def _contexts(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Two finer keys for each seed: with the words that follow it, and with those that lead to it."""
        for batch in batches:
            rows = [[np.empty(0, np.int64)] for _ in range(4)]
            ids, seeds = batch.column(0).to_numpy(), batch.column(2).to_pylist()
            for index, h, bounds in hashed_together(batch.column(1).to_pylist()):
                if len(h) < reach:
                    continue
                runs, (which, left) = shingle_hashes(h, reach), room(bounds)
                p = np.concatenate([start + np.array([x["p"] for x in seeds[i]], np.int64) for i, start in zip(index, bounds, strict=False)])
                p = p[p < len(h)]
                keys, places = [], []
                for side, at in ((1, p), (2, p - reach + 1)):
                    fits = (at >= bounds[which[p]]) & (left[np.maximum(at, 0)] >= reach)
                    keys.append(mixed(runs[at[fits]] + np.uint64(side)))
                    places.append(p[fits])
                q = np.concatenate(places)
                of, k, q, again = _distinct(which[q], np.concatenate(keys), q - bounds[which[q]])
                for at, x in zip(rows, (k, ids[index[of]], q, again), strict=True):
                    at.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in rows], names=["key", "id", "p", "again"])

    return run


@tidy
def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, min_run: int = MIN_RUN,
                      reach: int = REACH, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """One row for each passage of a document that an earlier one (by id) has: (id, start, end, first_id, first_start,
    first_end, cluster_id).

    [start, end) counts words; ``first_*`` is an earlier document's passage that it repeats, cluster_id the smallest id
    among the passages that repeats connect.  Passages have at least ``min_run`` words: runs of equal words, or paragraphs
    with a few words replaced, inserted or left out whose Jaccard similarity on ``shingle``-word shingles is ``percent`` or
    more.  Removing the rows' spans leaves every passage where it stands first.  Repeats within one document are not looked for.

    Documents of a bucket are compared with the one before them (by id), at every place where they have its key.  If that finds nothing, as for a phrase that many
    texts have, the bucket is refined: half of a run of ``min_run`` words lies before the seed or behind it, so documents
    that also agree there are compared, again each with the one before.

    Null and empty texts and rows with a null id have no passages; rows that share an id count as one document.  Texts
    are read whole; other columns are not looked at.
    """
    ready(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text")).where("id is not null and text is not null")
    least = least_run(min_run, shingle, percent)
    entries = materialize(src.mapInArrow(_bands(reach, bands, rows, shingle, least), ENTRY), "entries")
    compare = _compare(shingle, percent, min_run)

    met_sides, more_sides = _met(entries)
    discard(entries)
    places = ["a", _place(F.col("pa")).alias("pa"), "b", _place(F.col("pb")).alias("pb")]
    met, more = met_sides.select(*places), more_sides.select("id", _place(F.col("p")).alias("p"))
    found = matched(_worth_comparing(met_sides, docs.select(F.col(id_col).cast("long").alias("id"))).select(*places), src, compare)
    through = met.join(found, ["a", "b"]).where("pb >= start_b and pb < end_b").select("b", "pb").distinct()
    apart = met.join(through, ["b", "pb"], "left_anti")
    more = more.join(through, (more.id == through.b) & (more.p == through.pb), "left_anti")
    seeds = apart.select(F.col("a").alias("id"), F.col("pa").alias("p")).union(apart.select("b", "pb")).union(more)
    seeds = seeds.groupBy("id").agg(F.collect_set(F.struct("p")).alias("seeds"))
    finer = src.join(seeds, "id").select("id", "text", "seeds").mapInArrow(_contexts(min_run // 2), ENTRY)
    finer = materialize(finer, "finer")
    again = materialize(_met(finer)[0].join(met, ["a", "pa", "b", "pb"], "left_anti"), "again")
    discard(finer, met_sides, more_sides)
    return _clustered(materialize(found.union(matched(again, src, compare)), "found"))


def _worth_comparing(met: DataFrame, ids: DataFrame) -> DataFrame:
    """The seeds around which a run may be long enough to be looked at; texts need not be moved for the others.  Seeds of an id that
    has several texts all stay, because the words beside a place are those of one of them."""
    near = _may_run(F.col("pa"), F.col("pb"))
    twice = materialize(ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and id is not null").select("id"), "twice")
    out = met.where(near)
    if not twice.isEmpty():
        for x in ("a", "b"):
            out = out.union(met.where(~near).join(twice, F.col(x) == F.col("id"), "left_semi"))
    return out


def _met(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every place of a key in a document with the first place in the document before it (by id) that has the key; and the
    further places (id, p) in documents that are before another one."""
    firsts = neighbours(entries.where("again = 0").select("key", "id", "p"), ["key"], ["id", "p"])
    chain = materialize(firsts.where("prev_id <> id"), "chain")
    rest = entries.where("again = 1").select("key", "id", "p").union(firsts.where("prev_id = id").select("key", "id", "p"))
    rest = materialize(rest, "rest")  # at most one row of the chain belongs to each
    names = [F.col("prev_id").alias("a"), F.col("prev_p").alias("pa"), F.col("id").alias("b")]
    pairs = chain.select(*names, F.col("p").alias("pb")).union(rest.join(chain.drop("p"), ["key", "id"]).select(*names, F.col("p").alias("pb")))
    more = rest.join(chain.select("key", F.col("prev_id").alias("id")), ["key", "id"], "left_semi").select("id", "p").distinct()
    met, more = materialize(pairs.distinct(), "met"), materialize(more, "more")
    discard(chain, rest)
    return met, more


def _clustered(found: DataFrame) -> DataFrame:
    """Overlapping passages of a document are one node; repeats connect nodes."""
    a, b = (found.select(F.col(x).alias("id"), F.struct(F.col(f"start_{x}").alias("start"), F.col(f"end_{x}").alias("end")).alias("s")) for x in "ab")
    blocks = materialize(a.union(b).groupBy("id").agg(merged_spans(F.collect_set("s")).alias("spans")), "blocks")

    def with_node(rows: DataFrame, x: str) -> DataFrame:
        at = F.filter("spans", lambda s: (s["start"] <= F.col(f"start_{x}")) & (s["end"] > F.col(f"start_{x}")))
        node = F.xxhash64(F.col(x), F.get(at, F.lit(0))["start"])
        return rows.join(blocks.withColumnRenamed("id", x), x).withColumn(f"node_{x}", node).drop("spans")

    named = materialize(with_node(with_node(found, "a"), "b"), "named")
    labels = connected_components(named.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    ids = named.select(F.col("node_a").alias("node"), F.col("a").alias("id")).union(named.select("node_b", "b"))
    low = ids.join(labels, "node").groupBy("component").agg(F.min("id").alias("cluster_id"))
    out = named.join(labels, named.node_b == labels.node).join(low, "component")
    out = out.select(F.col("b").alias("id"), F.col("start_b").alias("start"), F.col("end_b").alias("end"), F.col("a").alias("first_id"),
                     F.col("start_a").alias("first_start"), F.col("end_a").alias("first_end"), "cluster_id")
    return out.distinct()


def removals(passages: DataFrame) -> DataFrame:
    """(id, spans): what to cut out of each document, without overlaps."""
    return passages.groupBy("id").agg(merged_spans(F.collect_set(F.struct("start", "end"))).alias("spans"))
