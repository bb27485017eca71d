"""Keyed merges without a transactional table format.

``merge_upsert`` is ``INSERT ... ON CONFLICT (keys) DO UPDATE`` as one full outer join: one shuffle of each
side on the key, no union of a left join with an anti-join.  For a date-partitioned fact the join is confined
to the partitions the batch touches (:func:`merge_touched`), which are then all that a stored fact writes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.session import materialize


class DuplicateKeyError(ValueError):
    """A source batch touches one key more than once (strict mode)."""


def dedupe_latest(df: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row per key: the one with the greatest ``order`` value; remaining ties go to the greatest row, so
    the choice never depends on input order.  A hash aggregate with map-side partial aggregation, so a hot key
    is reduced on the map side before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    ordered = ([order] if order else []) + [c for c in others if c != order]
    best = F.max(F.struct(*[F.col(c) for c in ordered])).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in ordered]) \
        .select(*df.columns)


def dedupe_stored(df: DataFrame, keys: list[str], order: str | None = None, part: Column | None = None) -> DataFrame:
    """:func:`dedupe_latest` for rows on storage, which are read more than once: only hashes of the keys are shuffled to find those that
    repeat (nulls are equal), and only rows of these are reduced, by their keys.  The others pass through as they are stored.

    ``part`` (a whole number, e.g. the day) says where rows repeat, if they do so in few places: places are dealt to 64 by it, and only
    rows of those with a repeated row are moved to be compared, and their result is written once."""
    h = F.xxhash64(*keys)
    place = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.coalesce(F.pmod(F.lit(0) if part is None else part, F.lit(64)), F.lit(0)).cast("int"))
    at = [] if part is None else [F.bit_or(place).alias("__at")]
    twice = df.groupBy(h.alias("__h")).agg(F.count(F.lit(1)).alias("__n"), *at).where("__n > 1").drop("__n")
    twice = materialize(twice, "twice")
    if twice.isEmpty():
        return df
    same = h == twice["__h"]
    if part is None:
        return df.join(twice, same, "left_anti").unionByName(dedupe_latest(df.join(twice, same, "left_semi"), keys, order))
    within = place.bitwiseAND(F.lit(twice.agg(F.bit_or("__at")).first()[0]).cast("bigint")) != 0
    some = df.where(within)
    once = some.join(twice, same, "left_anti").unionByName(dedupe_latest(some.join(twice, same, "left_semi"), keys, order))
    return df.where(~within).unionByName(materialize(once, "once"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def met_partitions(target: DataFrame, src: DataFrame, keys: list[str], partition_col: str) -> list[tuple]:
    """Pairs of a target partition and a source partition that have a key in common (a key may move between partitions).  Only
    hashes of the keys and the partition columns are read and shuffled; should hashes of different keys be equal, there is a pair too
    many.  At most one entry for each pair of partitions (e.g. of days), so it is collected."""
    def hashed(df: DataFrame, x: str) -> DataFrame:
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        return df.where(known).select(F.xxhash64(*[F.col(k).cast(target.schema[k].dataType) for k in keys]).alias(f"__h_{x}"), F.col(partition_col).alias(f"__{x}"))

    t, s = hashed(target, "t"), hashed(src, "s")
    return [tuple(r) for r in t.join(s, F.col("__h_t") == F.col("__h_s")).select("__t", "__s").distinct().collect()]


def in_parts(col: str, parts: list) -> Column:
    vals = [p for p in parts if p is not None]
    cond = F.col(col).isin(vals) if vals else F.lit(False)
    return cond | F.col(col).isNull() if None in parts else cond


def merge_upsert(target: DataFrame, src: DataFrame, keys: list[str], preserve: tuple | list = (),
                 order: str | None = None, strict: bool = False, partition_col: str | None = None) -> DataFrame:
    """Upsert ``src`` into ``target`` by ``keys`` and return the merged table.

    * source rows replace target rows with the same key, column by column, NULLs included;
    * ``preserve`` columns keep the target's value when the key already exists (first-seen ``created_at``);
    * a source key seen twice is reduced to its latest row by ``order`` (or raises with ``strict=True``).

    With ``partition_col`` (a fact partitioned by date) only the partitions the batch touches take part in the
    join: they are listed first (:func:`met_partitions`), the target is filtered to them (partition
    pruning on a partitioned table), and every other partition passes through unchanged with no shuffle.
    """
    if strict:
        dup = duplicate_keys(src, keys)
        if not dup.isEmpty():
            raise DuplicateKeyError(f"source has duplicate keys on {keys}: {dup.limit(5).collect()}")
    else:
        src = dedupe_latest(src, keys, order)
    if partition_col is not None:
        merged, parts = merge_touched(target, src, keys, preserve, partition_col, deduped=True)
        hit = in_parts(partition_col, parts)
        return target.where(~hit | hit.isNull()).unionByName(merged)
    return _full_outer_merge(target, src, keys, preserve)


def merge_touched(target: DataFrame, src: DataFrame, keys: list[str], preserve, partition_col: str,
                  order: str | None = None, deduped: bool = False) -> tuple[DataFrame, list]:
    """The merged rows of the partitions ``src`` touches, and the list of those partitions (some may be left without rows): the source
    rows' own values and the current values of the keys that it rewrites.  No other partition's rows are read, but for their keys.
    Only partitions that have a key in common are joined; a batch's other rows, most of which are new days, are not moved."""
    if not deduped:
        src = dedupe_latest(src, keys, order)
    met = met_partitions(target, src, keys, partition_col)
    from_t, from_s = {t for t, _ in met}, {s for _, s in met}
    own = {r[0] for r in src.select(partition_col).distinct().collect()}
    parts = list(own | from_t)
    rows = [target.where(in_parts(partition_col, list(own - from_t)))]
    if own - from_s:
        rows.append(src.where(in_parts(partition_col, list(own - from_s))).select(*target.columns))
    if met:
        rows.append(_full_outer_merge(target.where(in_parts(partition_col, list(from_t))), src.where(in_parts(partition_col, list(from_s))), keys, preserve))
    return reduce(DataFrame.unionByName, rows), parts


def _full_outer_merge(target: DataFrame, src: DataFrame, keys: list[str], preserve) -> DataFrame:
    cols = target.columns
    s = src.select(*cols).withColumn("__in_src", F.lit(True))
    t = target.select(*[F.col(c).alias(f"__t_{c}") for c in cols]).withColumn("__in_tgt", F.lit(True))
    cond = reduce(lambda a, b: a & b, [s[k] == t[f"__t_{k}"] for k in keys])
    j = s.join(t, cond, "full_outer")
    in_src = F.col("__in_src").isNotNull()
    in_tgt = F.col("__in_tgt").isNotNull()

    def pick(c: str) -> Column:
        if c in preserve:
            return F.when(in_tgt, F.col(f"__t_{c}")).otherwise(F.col(c)).alias(c)
        return F.when(in_src, F.col(c)).otherwise(F.col(f"__t_{c}")).alias(c)

    return j.select(*[pick(c) for c in cols])


def update_from(target: DataFrame, src: DataFrame, target_key: str, src_key: str, columns: dict[str, str]
                ) -> DataFrame:
    """``UPDATE target SET col = src.expr FROM src WHERE target.key = src.key``: one left join.
    ``src`` must already be unique on ``src_key``; ``columns`` maps target column -> source column."""
    s = src.select(F.col(src_key).alias("__uk"),
                   *[F.col(sc).alias(f"__u_{tc}") for tc, sc in columns.items()]).withColumn("__hit", F.lit(True))
    j = target.join(s, target[target_key] == s["__uk"], "left")
    hit = F.col("__hit").isNotNull()
    return j.select(*[F.when(hit, F.col(f"__u_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
                      for c in target.columns])
