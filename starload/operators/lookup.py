"""Resolving natural keys to surrogate keys.

Dimension sides are not broadcast by hint: their size grows with the data (customers, SKUs), so the choice is
left to AQE, which broadcasts a side only when its measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps the sort-merge join (and splits skewed
partitions).  Only frames with a fixed bound may be hinted by callers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.operators.dims import ACTIVE
from starload.operators.keys import carry_forward
from starload.session import materialize


def lookup(fact: DataFrame, dim: DataFrame, fact_keys: list[str], dim_keys: list[str], sk: str,
           active_only: bool = False, null_safe: bool = True) -> DataFrame:
    """Left-join ``fact`` to ``dim`` on the key columns and add ``sk`` (NULL when unresolved).

    ``active_only`` restricts a type-2 dimension to its current versions before the join (the literal
    predicate is applied to the dimension scan, below the join).
    """
    d = dim.where(F.col("current_row_indicator") == ACTIVE) if active_only else dim
    tmp = [f"__lk_{i}" for i in range(len(dim_keys))]
    d = d.select(F.col(sk), *[F.col(k).alias(t) for k, t in zip(dim_keys, tmp)])
    if sk in fact.columns:
        fact = fact.drop(sk)
    eq = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    cond = reduce(lambda a, b: a & b, [eq(fact[f], d[t]) for f, t in zip(fact_keys, tmp)])
    return fact.join(d, cond, "left").drop(*tmp)


def lookup_asof(fact: DataFrame, dim: DataFrame, fact_bk: str, bk: str, sk: str, at: str | Column,
                keys: DataFrame | None = None) -> DataFrame:
    """Left-join each fact row to the version of its business key valid at time ``at``: the last one, by effective time and
    surrogate key, that begins at ``at`` or before.  A key's first version stands for all time before it.  One row comes out
    for each fact row; a row without a key or a time, or of an unknown key, gets NULL.

    A key with one version needs no time: its rows are joined with it.  Rows and versions of the other keys are put into one
    order by (key, time) over range partitions, and each fact row gets the last version
    before it (:func:`starload.operators.keys.carry_forward`).  No row meets a version that isn't its own, so neither a long
    history nor a hot key multiplies rows, and a key with very many facts or versions is split over tasks.  ``keys`` (a frame
    whose only column holds the batch's business keys) keeps the versions of other keys out of the order.  The keys with
    several versions are written down, so that rows are told apart before they are moved where these are few.  ``fact`` is evaluated
    twice: have it on storage.
    """
    if sk in fact.columns:
        fact = fact.drop(sk)
    at = F.col(at) if isinstance(at, str) else at
    kind, f_type, key_type = dim.schema[sk].dataType, fact.schema, dim.schema[bk].dataType
    d = dim.where(F.col(bk).isNotNull()).select(F.col(bk).alias("__abk"), F.col(sk).alias("__ask"), "row_eff_time")
    if keys is not None:
        wanted = keys.toDF("__wanted").distinct()
        d = d.join(wanted, d["__abk"] == wanted["__wanted"], "left_semi")
    per_key = d.groupBy(F.col("__abk").alias("__fbk")).agg(F.min("row_eff_time").alias("__first"), F.count(F.lit(1)).alias("__n"), F.min("__ask").alias("__only"))
    per_key = materialize(per_key, "versions-per-key")
    several = materialize(per_key.where("__n > 1").select("__fbk", "__first"), "several-versions")
    same = F.col(fact_bk).cast(key_type) == F.col("__fbk")
    plain = fact.join(several.select("__fbk"), same, "left_anti").join(per_key.where("__n = 1").select("__fbk", "__only"), same, "left")
    plain = plain.select(*fact.columns, F.when(at.isNotNull(), F.col("__only")).alias(sk))
    d = d.join(several, F.col("__abk") == F.col("__fbk")).withColumn("__aat", F.when(F.col("row_eff_time") != F.col("__first"), F.col("row_eff_time")))
    versions = d.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in f_type.fields], "__abk", "__aat", F.lit(False).alias("__is_fact"), "__ask")
    rows = fact.join(several.select("__fbk"), same, "left_semi")
    rows = rows.withColumns({"__abk": F.col(fact_bk).cast(key_type), "__aat": at, "__is_fact": F.lit(True), "__ask": F.lit(None).cast(kind)})
    told = carry_forward(versions.unionByName(rows), "__abk", ["__aat", "__is_fact", "__ask"], F.col("__ask"), sk).where("__is_fact")
    known = F.col("__aat").isNotNull() & F.col("__abk").isNotNull()
    return plain.unionByName(told.withColumn(sk, F.when(known, F.col(sk))).select(*fact.columns, sk))
