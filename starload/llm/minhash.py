"""Near-duplicate documents by MinHash with tensored banding.

A few small collections of hash functions are computed, each combining ``rows`` minima; the keys of the hash tables are
all pairs of collections.  ``collections`` choose 2 tables therefore cost ``collections * rows`` minima instead of
``tables * 2 * rows``.  Two sets of similarity J meet in a table if two collections agree: with 16 collections of 3 minima
a pair at the threshold of 0.8 is missed with probability 2e-4, one at 0.9 with 3e-9.

Sets that are equal are one node from the start.  Within a bucket every member is compared with the smallest one;
afterwards only members of a bucket that still lie in different components are compared, so a bucket of near copies costs
its size, not its square.  In a crowded bucket they first try random other members, so that most of what is linked over several
steps is one component before pairs are made.  Where many members are still apart (texts that share much, but too little), pairs are made by
their rare shingles instead: sets that are similar enough share one among the first few of each, in the order from rare to
frequent, so members whose rare shingles are their own meet nobody.  Every pair that could change a component is checked on
the full sets, unless the sizes or those shingles rule it out or, in a small bucket, fewer than half of all minima agree (at a
similarity of 0.8 one pair in a million).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.common import discard, materialize, mixed, ready, shingle_hashes, text_bytes, tidy, word_hashes
from starload.llm.components import connected_components

COLLECTIONS, ROWS = 16, 3
#: Members of a bucket that are compared in all pairs, if some of them are apart; more are paired by their rare shingles.
CROWD = 16


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; A-Z are lower-cased, words end at ASCII white space."""
    return np.unique(shingle_hashes(word_hashes((text or b"").lower()), k))


def _signature(s: np.ndarray, collections: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The value of every collection, and eight bits of every minimum."""
    seeds = mixed(np.arange(1, collections * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    low = np.array([(s * a).min() for a in seeds], np.uint64).reshape(collections, rows)
    out = np.zeros(collections, np.uint64)
    for r in range(rows):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + low[:, r])
    return out.view(np.int64), (mixed(low.ravel()) & np.uint64(255)).astype(np.int16)


def _sketches(k: int, collections: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key, sig, bits = [], [], [], []
            for text in batch.column(2):
                s = shingle_set(text.as_py(), k)
                n.append(len(s))
                key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                values, eight = _signature(s, collections, rows) if len(s) else (None, None)
                sig.append(values)
                bits.append(eight)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int16()))],
                names=["id", "text_hash", "n_shingles", "set_key", "sig", "bits"],
            )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), k).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "s"])

    return run


@tidy
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80,
                    collections: int = COLLECTIONS, rows: int = ROWS) -> DataFrame:
    """One row for each row of ``docs``: (id, text_hash, n_shingles, component_id, group), where documents with
    100 * |A & B| >= percent * |A | B| are linked (``percent`` is 80 at least), component_id is the smallest id that links lead to, group a number that
    a component's rows share (null for empty sets), and text_hash the text's xxhash64.

    ``id_col`` is an integer.  Null and empty texts have n_shingles 0 and are linked with nothing (component_id is their
    own id).  Rows with a null id are linked like others, but never name a component, unless it has no other id (then
    null).  Repeated rows give repeated results; rows that share an id are one document for ``component_id``'s minimum
    only.  Very long texts are read whole.  Other columns are not looked at.
    """
    if percent < 80:
        raise ValueError("the tables and the test of the minima are laid out for a similarity of 80 per cent or more")
    spark = ready(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), text_bytes(text_col).alias("text"))
    sketch = materialize(src.mapInArrow(_sketches(shingle, collections, rows), "id long, text_hash long, n_shingles long, set_key binary, sig array<long>, bits array<smallint>"), "sketch")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("rep")
    nodes = sketch.where("set_key is not null").groupBy("set_key").agg(first, F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bits").alias("bits"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    g = [F.col("sig")[i] for i in range(collections)]
    keys = F.array(*[F.xxhash64(F.lit(t), g[i], g[j]) for t, (i, j) in enumerate(combinations(range(collections), 2))])
    entries = nodes.select("node", F.posexplode(keys).alias("t", "key"))
    buckets = materialize(entries.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("a"), F.max("node").alias("b")).where("size > 1"), "buckets")
    # a bucket of two is its pair; larger ones are listed, for pairs with their smallest member
    large = buckets.where("size > 2").select("key", F.col("a").alias("pivot"))
    members = materialize(entries.join(large, "key").select("t", "key", "pivot", "node"), "members")
    pairs = buckets.where("size = 2").select("a", "b").union(members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    links = _linked(src, nodes, materialize(pairs.distinct(), "pairs"), shingle, percent)
    labels = connected_components(links)
    known = nodes.select("node", "n", "sig", "bits")
    # similar sets have similar sizes, and agree in half of the minima but for one in a million
    agree = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    alike = F.expr(f"component_a <> component_b and 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)") & (agree * 2 >= collections * rows)
    # members of crowded buckets that are still apart: each tries a random member of each of its buckets, and is checked with the most alike
    dealt = materialize(_apart(members, labels).where("crowded").select("key", "node", "component"), "dealt")
    if not dealt.isEmpty():
        drawn = dealt.groupBy("key").agg(F.max_by(F.struct("node", "component"), F.xxhash64("key", "node")).alias("r")).select("key", "r.*")
        drawn = drawn.select("key", *[F.col(c).alias(f"{c}_b") for c in ("node", "component")])
        tried = dealt.select("key", *[F.col(c).alias(f"{c}_a") for c in ("node", "component")]).join(drawn, "key").where("component_a <> component_b").drop("key").distinct()
        for x in "ab":  # a pair that meets in many buckets gets the sketches once
            tried = tried.join(known.select(*[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "bits")]), f"node_{x}")
        best = materialize(tried.where(alike).groupBy(F.col("node_a").alias("a")).agg(F.max_by("node_b", F.struct(agree, "node_b")).alias("b")), "pairs")
        discard(dealt)
        links = links.union(_linked(src, nodes, best, shingle, percent))
        labels = connected_components(links)
    # then every such pair is compared, in a crowded bucket those that share a rare shingle
    apart = materialize(_apart(members, labels), "apart")
    crowd = apart.where("crowded").select("node", "component").distinct().join(nodes.select("node", "n"), "node")
    few = materialize(apart.where("not crowded").join(known, "node"), "few")
    left, right = (few.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("t", "node", "component", "n", "sig", "bits")]) for x in "ab")
    ordered = F.col("node_a") < F.col("node_b")
    # a pair that meets in several tables is made in the first of them
    same = F.filter(F.sequence(F.lit(0), F.lit(collections - 1)), lambda i: F.get("sig_a", i) == F.get("sig_b", i))
    i, j = F.get(same, F.lit(0)), F.get(same, F.lit(1))
    first = F.expr("t_a") == (i * (2 * collections - 1 - i) / 2 + j - i - 1).cast("int")
    met = left.alias("l").join(right.alias("r"), (F.col("l.key") == F.col("r.key")) & ordered & alike & first)
    met = met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    more = met.union(_sharing_rare(src, nodes, materialize(crowd, "crowd"), shingle, percent)).distinct().join(pairs, ["a", "b"], "left_anti")
    more = materialize(more, "pairs")
    if more.limit(1).count():
        found = _linked(src, nodes, more, shingle, percent)
        labels = connected_components(links.union(found))

    named = nodes.join(labels, "node", "left").select("set_key", F.col("rep.id").alias("low"), F.coalesce("component", "node").alias("component"))
    low = named.groupBy("component").agg(F.min("low").alias("component_id"))
    by_key = named.join(low, "component").select("set_key", "component_id", F.col("component").alias("group"))
    out = sketch.select("id", "text_hash", "n_shingles", "set_key").join(by_key, "set_key", "left")
    return out.select("id", "text_hash", "n_shingles", "group", F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that lie in more than one component; ``crowded`` tells of large buckets."""
    placed = members.join(labels, "node", "left").select("t", "key", "node", F.coalesce("component", "node").alias("component"))
    split = placed.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d"), F.count("*").alias("size"))
    split = split.where("c <> d").select("key", (F.col("size") > CROWD).alias("crowded"))
    return placed.join(split, "key")


def _full_sets(src: DataFrame, nodes: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, s) of the ``wanted`` nodes: their shingles, made anew from their texts."""
    reps = nodes.join(wanted, "node").select("node", F.col("rep.id").alias("rid"), F.col("rep.text_hash").alias("rhash"))
    texts = src.join(reps, F.col("id").eqNullSafe(F.col("rid")) & (F.col("text_hash") == F.col("rhash"))).select("node", "text")
    return materialize(texts.mapInArrow(_sets(shingle), "node long, s array<long>").dropDuplicates(["node"]), "sets")


def _sharing_rare(src: DataFrame, nodes: DataFrame, crowd: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ``crowd(node, component, n)`` from different components that may be similar enough.

    Sets of n and m shingles that are must share ``percent * (n + m) / (100 + percent)`` of them.  In any common order of all
    shingles the first shared one has the others behind it, which bounds its place in both sets; only pairs that share a shingle
    within these bounds are made.  The order is from rare to frequent, so that few sets share the first ones."""
    if crowd.isEmpty():
        return crowd.select(F.col("node").alias("a"), F.col("node").alias("b"))
    tokens = _full_sets(src, nodes, crowd.select("node"), shingle).select("node", F.explode("s").alias("x"))
    ranked = tokens.join(tokens.groupBy("x").agg(F.count("*").alias("df")), "x")
    ranked = ranked.withColumn("at", F.row_number().over(Window.partitionBy("node").orderBy("df", "x"))).where("df > 1")
    early = ranked.join(crowd, "node").where(f"100 * (n - at + 1) >= {percent} * n")  # the bound of the smallest sets that it may be similar to
    early = materialize(early.select("x", "node", "component", "n", "at"), "early")
    mixed = early.groupBy("x").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c <> d").select("x")
    early = early.join(mixed, "x", "left_semi")
    small, large = (early.select("x", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "component", "n", "at")]) for s in "ab")
    small = small.where(f"{100 + percent} * (n_a - at_a + 1) >= {2 * percent} * n_a")  # shared with a set of its size or larger
    shared = f"{percent} * (n_a + n_b)"
    fits = [f"(n_a < n_b or n_a = n_b and node_a < node_b) and component_a <> component_b and 100 * n_a >= {percent} * n_b",
            *[f"{100 + percent} * (n_{s} - at_{s} + 1) >= {shared}" for s in "ab"]]
    met = small.alias("s").join(large.alias("l"), (F.col("s.x") == F.col("l.x")) & F.expr(" and ".join(fits)))
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))


def _linked(src: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; sets are made anew from the texts of the pairs' nodes only."""
    n = nodes.select("node", "n")
    sized = pairs.join(n.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
    sized = materialize(sized.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)"), "sized")
    sets = _full_sets(src, nodes, sized.select(F.col("a").alias("node")).union(sized.select(F.col("b").alias("node"))).distinct(), shingle)
    both = sized.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    hit = both.select("a", "b", "na", "nb", shared.alias("shared")).where(f"100 * shared >= {percent} * (na + nb - shared)")
    return materialize(hit.select("a", "b"), "links")
