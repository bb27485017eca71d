"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component is the smallest node that can be reached.

    In every round each node that has a smaller neighbour points to the smallest; the pointers are followed to their ends
    by doubling, and the edges are contracted to these ends.  Only local minima are left then, so the edges shrink fast (a
    star is gone after one round).  All tables are written to the shared checkpoint folder, so a lost executor repeats one
    step at most.  Minima are aggregated before the shuffle, and a join on a hot node can be split.  Edges with a null end
    are ignored; an empty table gives an empty result.
    """
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    edges = materialize(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct(), "edges")
    labels = None
    while edges.limit(1).count():
        up = _ends(materialize(edges.groupBy("b").agg(F.min("a").alias("up")).withColumnRenamed("b", "node"), "up"))
        if labels is None:
            labels = up.select("node", F.col("up").alias("component"))
        else:  # ends of earlier rounds have moved on
            moved = up.select(F.col("node").alias("component"), "up")
            old = labels.join(moved, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
            labels = materialize(old.union(up.join(labels, "node", "left_anti").select("node", "up")), "labels")
        low = edges.join(up.select(F.col("node").alias("b"), F.col("up").alias("eb")), "b")
        both = low.join(up.select(F.col("node").alias("a"), F.col("up").alias("ea")), "a", "left").select(F.coalesce("ea", "a").alias("x"), F.col("eb").alias("y"))
        edges = materialize(both.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    ends = labels.select(F.col("component").alias("node")).distinct()
    return labels.union(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("component")))


def _ends(up: DataFrame) -> DataFrame:
    """Pointers (node, up), which lead to smaller nodes, followed to where they end."""
    while True:
        further = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
        if not up.join(further, "up", "left_semi").limit(1).count():
            return up
        up = materialize(up.join(further, "up", "left").select("node", F.coalesce("top", "up").alias("up")), "up")
