"""Hard negatives by threshold joins of vectors.

For every anchor the best rows inside windows of scores are searched: first the best rows of its own label (its positives, one
window without bounds), then, for each positive, the best rows of other labels whose score is a given share of the positive's.

Anchors and rows meet in a grid of blocks, each cell of bounded size.  In a cell the dimensions are sorted by their weight in
the block, and for the score that is wanted at least:

* the inverted index holds only the leading dimensions of each row: a suffix whose norm, times the longest suffix of an anchor,
  stays below that score can't reach it alone and is left out;
* partial scores are accumulated along the index, and rows go as soon as their norm that remains can't lift any pair to the score;
* pairs that are left are completed with the dimensions that the index omits.

The score that is wanted starts high and is lowered until each window of the cell is full or its lower bound is reached.  A
sixteenth of the blocks goes first: the last score of a window that they fill is what the other blocks must reach.  Only the best
rows of a window leave a cell, also among ties, so many copies of one vector cost nothing.

The work stays anchors x rows, as a search with stated queries is, and shrinks by what the bounds exclude.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.common import materialize, tidy

#: Rows of a block and anchors of a group at most.  n rows are dealt to sqrt(n / GRAIN) blocks, so that blocks and their number grow
#: together, until blocks are as large as they may be.
BLOCK, GROUP, GRAIN = 1 << 16, 1 << 13, 256
#: Dimensions that are accumulated at once, and anchors that are looked up together.
CHUNK, SLICE = 8, 128
#: One block in so many is searched first.
FIRST = 16
#: How far the wanted score falls from a window's upper end to its lower end, step by step.
STEPS = (0.25, 0.375, 0.5, 1.0)
FOUND = "anchor long, arow long, window long, other long, orow long, score long"


def quantized(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as longs; null if the vector or a component is null, infinite or not a number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _tails(v: np.ndarray, cuts: list[int]) -> np.ndarray:
    """The norm of each row's dimensions from every cut on; nothing is left behind the last one."""
    sq = np.add.reduceat(v.astype(np.float64) ** 2, cuts[:-1], axis=1)
    left = np.cumsum(sq[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([left, np.zeros((len(v), 1))], axis=1)) * (1 + 1e-9)


def pairs_above(q: np.ndarray, x: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (i, j, q[i] . x[j]) with a score of ``floor[i]`` or more; scores are whole numbers."""
    order = np.argsort(-(x.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    q, x = q[:, order], x[:, order]
    cuts = [*range(0, q.shape[1], CHUNK), q.shape[1]]
    tq, tx, last = _tails(q, cuts), _tails(x, cuts), len(cuts) - 1
    depth = np.minimum((tq.max(axis=0) * tx >= floor.min() - 0.5).sum(axis=1), last)  # chunks of each row in the index
    rows = np.argsort(-depth, kind="stable")
    x, tx, depth = x[rows], tx[rows], depth[rows]
    score = np.zeros((len(q), len(x)), q.dtype)
    for c in range(last):
        inside = int(np.count_nonzero(depth > c))
        if inside == 0:
            break
        score[:, :inside] += q[:, cuts[c] : cuts[c + 1]] @ x[:inside, cuts[c] : cuts[c + 1]].T
        if 2 * (c + 1) == last:  # rows that no anchor can lift to its floor any more
            at = np.minimum(depth, c + 1)
            rest = tq[:, at] * tx[np.arange(len(x)), at]
            alive = (score + rest >= floor[:, None] - 0.5).any(axis=0)
            x, tx, depth, rows, score = x[alive], tx[alive], depth[alive], rows[alive], score[:, alive]
    rest = tq[:, depth] * tx[np.arange(len(x)), depth]
    i, j = np.nonzero(score + rest >= floor[:, None] - 0.5)
    found = score[i, j]
    omitted = depth[j] < last
    if omitted.any():
        tail = x * (np.arange(x.shape[1]) >= np.asarray(cuts)[depth][:, None])
        if omitted.sum() * 8 > score.size:
            found = found + (q @ tail.T)[i, j]
        else:
            for at in range(0, len(i), 1 << 15):
                s = slice(at, at + (1 << 15))
                found[s] = found[s] + (q[i[s]] * tail[j[s]]).sum(axis=1)
    good = found >= floor[i]
    return i[good], rows[j[good]], found[good]


def best_in_windows(of: np.ndarray, lo: np.ndarray, hi: np.ndarray, i: np.ndarray, j: np.ndarray, score: np.ndarray, tie: tuple, k: int):
    """For windows (anchor ``of``, from ``lo`` to ``hi``) the first ``k`` pairs each: window, index of the pair; and how many."""
    order = np.lexsort((*(t[j] for t in reversed(tie)), -score, i))
    values, rank = np.unique(np.concatenate([score, hi]), return_inverse=True)
    step = len(values) + 1
    key = i[order].astype(np.int64) * step - rank[: len(score)][order]
    start = np.searchsorted(key, of.astype(np.int64) * step - rank[len(score) :])
    at = start[:, None] + np.arange(k)
    inside = np.minimum(at, max(len(order) - 1, 0))
    good = (at < len(order)) & (len(order) > 0)
    if len(order):
        good &= (i[order][inside] == of[:, None]) & (score[order][inside] >= lo[:, None])
    w, c = np.nonzero(good)
    return w, order[at[w, c]], good.sum(axis=1)


def fill_windows(q: np.ndarray, x: np.ndarray, of: np.ndarray, lo: np.ndarray, hi: np.ndarray, known: np.ndarray, allowed, tie: tuple, k: int):
    """The best ``k`` pairs of every window, with the wanted score lowered until it is full or ``lo`` is reached.
    ``allowed(i, j)`` says which pairs count; ``known`` windows begin at ``lo``.  Yields (window, j, score)."""
    if not len(x) or not len(of):
        return
    reach = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1)) * np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max()) + 1
    top, low = np.minimum(hi, reach[of]), np.maximum(lo, -reach[of])
    todo = np.flatnonzero(top >= low)
    for n, share in enumerate(STEPS):
        if not len(todo):
            return
        floor = top[todo] - (top[todo] - low[todo]) * share
        floor = np.where(known[todo] | (share == 1.0), low[todo] - np.abs(low[todo]) * 1e-12, floor)
        wanted = np.full(len(q), np.inf)
        np.minimum.at(wanted, of[todo], floor)
        busy = np.flatnonzero(wanted < np.inf)
        parts = []
        for at in range(0, len(busy), SLICE):
            some = busy[at : at + SLICE]
            i, j, s = pairs_above(q[some], x, wanted[some])
            ok = allowed(some[i], j)
            parts.append((some[i][ok], j[ok], s[ok].astype(np.int64)))
        i, j, s = (np.concatenate(p) for p in zip(*parts, strict=True))
        w, pair, full = best_in_windows(of[todo], lo[todo], hi[todo], i, j, s, tie, k)
        done = known[todo] | (full >= k) | (share == 1.0)
        keep = done[w]
        yield todo[w[keep]], j[pair[keep]], s[pair[keep]]
        todo = todo[~done]


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    flat = table.column("vec").combine_chunks()
    values = (flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])).to_numpy(zero_copy_only=False)
    return values.reshape(table.num_rows, width)


def _search(anchors: DataFrame, rows: DataFrame, blocks: int, groups: int, width: int, same: bool, k: int, part: Column) -> DataFrame:
    """The best ``k`` rows of each window of ``anchors(id, row, label, vec, windows, lo, hi, known)`` in the blocks of ``part``.
    ``same``: rows of the anchor's label, otherwise rows of the other labels."""
    b = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    left = anchors.select("*", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("grp")).select("*", b).where(part)
    right = rows.where(part).select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"))
    right = right.toDF(*right.columns)  # columns of its own: both sides come from one table

    def cell(a: pa.Table, r: pa.Table) -> pa.Table:
        names = FOUND.replace(" long", "").split(", ")
        none = pa.Table.from_arrays([pa.array([], pa.int64())] * len(names), names=names)
        if a.num_rows == 0 or r.num_rows == 0:
            return none
        q, x = _matrix(a, width), _matrix(r, width)
        longest = lambda v: float((v.astype(np.float64) ** 2).sum(axis=1).max()) ** 0.5
        kind = np.float64 if longest(q) * longest(x) < 2**52 else object  # sums of doubles are exact so far
        q, x = q.astype(kind), x.astype(kind)
        aid, arow, alab = (a.column(c).to_numpy() for c in ("id", "row", "label"))
        rid, rrow, rlab = (r.column(c).to_numpy() for c in ("id", "row", "label"))
        lists = {c: a.column(c).combine_chunks() for c in ("windows", "lo", "hi", "known")}
        of = np.repeat(np.arange(a.num_rows), lists["windows"].value_lengths().to_numpy(zero_copy_only=False))
        win = lists["windows"].flatten().to_numpy(zero_copy_only=False)
        lo, hi = (lists[c].flatten().to_numpy(zero_copy_only=False) for c in ("lo", "hi"))
        known = lists["known"].flatten().to_numpy(zero_copy_only=False).astype(bool)
        out = []
        for label in np.unique(alab) if same else [None]:
            some = np.flatnonzero(rlab == label) if same else np.arange(r.num_rows)
            mine = np.flatnonzero(alab[of] == label) if same else np.arange(len(of))
            allowed = (lambda i, j, some=some: arow[i] != rrow[some][j]) if same else (lambda i, j: alab[i] != rlab[j])
            for w, j, s in fill_windows(q, x[some], of[mine], lo[mine], hi[mine], known[mine], allowed, (rid[some], rrow[some]), k):
                w, j = mine[w], some[j]
                out.append([aid[of[w]], arow[of[w]], win[w], rid[j], rrow[j], s])
        if not out:
            return none
        return pa.Table.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)], names=names)

    return left.groupBy("block", "grp").cogroup(right.groupBy("block", "grp")).applyInArrow(cell, FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("anchor", "arow", "window").orderBy(F.desc("score"), "other", "orow")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def best_rows(anchors: DataFrame, rows: DataFrame, n_rows: int, n_anchors: int, width: int, same: bool, k: int) -> DataFrame:
    """The best ``k`` rows of every window (FOUND and ``rank``): a part of the blocks first, then the others from its scores on."""
    blocks, groups = max(-(-n_rows // BLOCK), int((n_rows / GRAIN) ** 0.5), 1), -(-n_anchors // GROUP)
    part = lambda first: F.col("block") < -(-blocks // FIRST) if first else F.col("block") >= -(-blocks // FIRST)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int"))
    unknown = anchors.withColumn("known", F.transform("windows", lambda w: F.lit(False)))
    early = materialize(_first(_search(unknown, dealt, blocks, groups, width, same, k, part(True)), k), "early")
    floors = early.groupBy(F.col("arow").alias("frow"), F.col("window").alias("fwin")).agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    floors = floors.groupBy("frow").agg(F.map_from_entries(F.collect_list(F.struct("fwin", "floor"))).alias("floors"))
    told = anchors.join(floors, anchors["row"] == floors["frow"], "left")
    floor = F.transform("windows", lambda w: F.try_element_at("floors", w))
    told = told.withColumn("known", F.transform(floor, lambda f: f.isNotNull())).withColumn("lo", F.zip_with("lo", floor, lambda a, b: F.greatest(a, b))).drop("frow", "floors")
    late = _search(told, dealt, blocks, groups, width, same, k, part(False))
    return _first(early.drop("rank").union(late), k)


@tidy
def hard_negatives(vectors: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label", positives: int = 5,
                   negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """Hard negatives (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows where ``anchors`` holds.

    A score is the inner product of two vectors whose components are floor(scale * x).  An anchor's positives are the first
    rows of its label besides itself, higher scores first, ties by the smaller key; a positive's negatives are the first rows of
    other labels whose score is from ``low`` to ``high`` per cent of the positive's.

    Rows with a null key, label, vector or component, or one that isn't finite, take no part.  Equal rows count once; rows
    that share a key but differ are different rows.  A shorter vector is filled with zeros.  Other columns don't matter; an
    empty table gives an empty result.  Scores must fit in a long.
    """
    got = vectors.select(F.col(key).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
                         quantized(F.col(vector), scale).alias("vec"), anchors.alias("is_anchor"))
    got = got.where("id is not null and label is not null and vec is not null").distinct()
    rows = materialize(got.withColumn("row", F.xxhash64("id", "label", "vec")), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("anchors"), F.max(F.size("vec")).alias("width")).first()
    columns = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not size["anchors"]:
        return vectors.sparkSession.createDataFrame([], columns)
    width = max(size["width"], 1)
    rows = rows.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vec"))))
    chosen = rows.where("is_anchor").select("id", "row", "label", "vec")
    rows = rows.select("id", "row", "label", "vec")
    far = 2**62
    one = lambda v, kind="long": F.array(F.lit(v).cast(kind))
    open_windows = chosen.select("*", one(0).alias("windows"), one(-far).alias("lo"), one(far).alias("hi"))
    near = materialize(best_rows(open_windows, rows, size["n"], size["anchors"], width, True, positives), "positives")
    # scores are whole: from the least one of ``low`` per cent to the greatest one of ``high`` per cent
    p, hundred = F.col("score").cast("decimal(20,0)"), F.lit(100).cast("decimal(3,0)")
    bounds = near.select(F.col("arow").alias("prow"), F.struct(F.col("orow").alias("w"), F.ceil(p * low / hundred).cast("long").alias("lo"),
                                                             F.floor(p * high / hundred).cast("long").alias("hi")).alias("b")).where("b.lo <= b.hi")
    bounds = bounds.groupBy("prow").agg(F.collect_list("b").alias("b")).select("prow", F.col("b.w").alias("windows"), F.col("b.lo").alias("lo"), F.col("b.hi").alias("hi"))
    windows = chosen.join(bounds, chosen["row"] == bounds["prow"]).drop("prow")
    far_rows = best_rows(windows, rows, size["n"], size["anchors"], width, False, negatives)
    pos = near.select("arow", F.col("orow").alias("window"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    return far_rows.join(pos, ["arow", "window"]).select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int"),
                                                         F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
