"""Dimension maintenance: insert-if-absent (type 0) and versioned (type 2) dimensions.

All joins on natural keys are null-safe (``<=>``): a NULL attribute is a value like any other, so a location
with no place is loaded once and facts still resolve to it.  Spark plans ``<=>`` keys as ordinary hash or
sort-merge join keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.operators.keys import assign_surrogate_keys, count_before, nearest_value, range_ordered, start_value, successor_value
from starload.schemas import SCD2_COLUMNS
from starload.session import materialize

ACTIVE = "Active"
EXPIRED = "Expired"


def null_safe_on(left: DataFrame, right: DataFrame, left_cols, right_cols=None) -> Column:
    right_cols = right_cols or left_cols
    return reduce(lambda a, b: a & b, [left[lc].eqNullSafe(right[rc]) for lc, rc in zip(left_cols, right_cols)])


def _max_key(target: DataFrame, sk: str) -> DataFrame:
    return target.agg(F.max(sk))


def insert_ignore(target: DataFrame, src: DataFrame, keys: list[str], sk: str,
                  src_keys: list[str] | None = None) -> DataFrame:
    """``INSERT ... SELECT DISTINCT ... ON CONFLICT (keys) DO NOTHING`` for a type-0 dimension.

    ``src_keys`` names the source columns when they differ from the dimension's (e.g. ``device`` ->
    ``device_name``).  Returns the whole new dimension: existing rows unchanged, new key combinations appended
    with keys above the current maximum, numbered in key order.
    """
    src_keys = src_keys or keys
    candidates = src.select(*[F.col(s).alias(k) for s, k in zip(src_keys, keys)]).dropDuplicates()
    existing = target.select(*keys)
    new = candidates.join(existing, null_safe_on(candidates, existing, keys), "left_anti")
    new = assign_surrogate_keys(new, keys, sk, start=_max_key(target, sk))
    return target.unionByName(new.select(*target.columns))


def _distinct_on(attrs: list[str], a: DataFrame, b: DataFrame, b_attrs: list[str]) -> Column:
    return reduce(lambda x, y: x | y, [~a[x].eqNullSafe(b[y]) for x, y in zip(attrs, b_attrs)])


def _history(target: DataFrame, sightings: DataFrame, bk: str, attrs: list[str], sk: str) -> tuple[DataFrame, list[str], DataFrame]:
    """Versions of the batch's keys, and the sightings (``bk``, ``attrs``, ``row_eff_time``) that begin a version (``__new``), in range
    partitions of their order by key and time; the columns of that order behind the key; and the batch's keys.

    A sighting that equals a version that began at the same time is that version; any other one is compared with the event before
    it, be it a version or a sighting.  At one time versions come first, in the order of their keys, then sightings in the order
    of their attributes.  A sighting with nothing before it is new, also where the key's first version, which begins later, looks
    the same.  Where all versions and sightings of a key look the same, which most do, only its earliest sighting can be new, and no
    other one is put into the order.  Sightings are reduced to one for each (key, attributes, time) before the shuffle; a key with very
    many events is split over tasks (:func:`starload.operators.keys.nearest_value`)."""
    seen = sightings.where(F.col(bk).isNotNull() & F.col("row_eff_time").isNotNull())
    sets = materialize(seen.groupBy(bk, *attrs).agg(F.min("row_eff_time").alias("row_eff_time")), "sets")
    keys = sets.select(bk).distinct()
    of_key = target.join(keys, bk, "left_semi")
    looks = sets.select(bk, *attrs).unionByName(of_key.select(bk, *attrs)).distinct()
    changing = materialize(looks.groupBy(bk).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(bk), "changing")
    version = F.struct(F.col(sk).alias("seq"), "updated_at")
    what = [bk, *attrs, "row_eff_time"]
    seen = sets.join(changing, bk, "left_anti").select(*what).unionByName(seen.join(changing, bk, "left_semi").select(*what))
    both = of_key.select(*what, version.alias("__v")).unionByName(seen.withColumn("__v", F.lit(None).cast(of_key.select(version.alias("v")).schema["v"].dataType)))
    # equal versions, if there are any, stay apart; sightings add nothing to the list
    events = both.groupBy(*what).agg(F.collect_list("__v").alias("__v")).select(*what, F.explode_outer("__v").alias("__v"))
    events = events.select(*what, F.col("__v.seq").alias("__seq"), F.col("__v.updated_at").alias("updated_at"), F.col("__v").isNull().alias("__sighting"))
    order = ["row_eff_time", "__sighting", "__seq", *attrs]
    told = nearest_value(range_ordered(events, [bk, *order]), bk, order, F.struct(*[F.col(a) for a in attrs]), "__before")
    same = reduce(lambda x, y: x & y, [F.col(a).eqNullSafe(F.col(f"__before.{a}")) for a in attrs])
    new = F.col("__sighting") & (F.col("__before").isNull() | ~same)
    return told.withColumn("__new", new).where("__new or not __sighting").drop("__before", "__sighting"), ["row_eff_time", "__new", "__seq", *attrs], keys


def _history_apply(target: DataFrame, sightings: DataFrame, bk: str, attrs: list[str], sk: str) -> DataFrame:
    """The whole dimension with a batch's new versions, keys and expiry derived from one order of the touched keys."""
    start = _max_key(target, sk)
    told, order, keys = _history(target, sightings, bk, attrs, sk)
    rows = materialize(told, "versions")
    rows = nearest_value(rows, bk, order, F.col("row_eff_time"), "__next", behind=True)
    rows = count_before(rows, [bk, *order], F.col("__new"), "__n")
    key = F.when(F.col("__new"), start_value(start) + F.col("__n") + 1).otherwise(F.col("__seq"))
    rows = rows.select(key.alias(sk), bk, *attrs, "row_eff_time", F.col("__next").alias("row_exp_time"),
                       F.when(F.col("__next").isNull(), F.lit(ACTIVE)).otherwise(F.lit(EXPIRED)).alias("current_row_indicator"),
                       F.when(F.col("__new"), F.col("row_eff_time")).otherwise(F.col("updated_at")).alias("updated_at"))
    rest = target.join(keys, bk, "left_anti")
    return rest.unionByName(rows.select(*target.columns))


def _sightings(src: DataFrame, bk: str, attrs: list[str], ts: str, src_bk: str | None, src_attrs: list[str] | None) -> DataFrame:
    return src.select(F.col(src_bk or bk).alias(bk), *[F.col(s).alias(a) for s, a in zip(src_attrs or attrs, attrs)],
                      F.timestamp_seconds(F.col(ts)).alias("row_eff_time"))


def scd2_changes(target: DataFrame, src: DataFrame, bk: str, attrs: list[str], ts: str,
                 src_bk: str | None = None, src_attrs: list[str] | None = None,
                 compare: str = "history", eff: str = "min") -> DataFrame:
    """New versions to insert into a type-2 dimension: rows with the dimension's columns except the surrogate key.
    Rows without a business key are left out.

    ``compare="history"`` follows each key through time (:func:`_history`): a sighting begins a version where it
    differs from what was valid just before it, so A, B, A in one batch are three versions, and a batch that was loaded
    before adds nothing, also when newer ones came in between.  (If a late batch has put a version into its time since, the
    sightings after that version count: they say that it ended.)

    The other two are rules of the original statements.  They take one candidate per (business key, attribute set) in the batch, effective from the earliest (``eff="min"``)
    or latest (``eff="max"``) sighting of ``ts`` (epoch seconds).  A candidate is new when its key is unknown or
    its attributes differ (null-safe) from the key's Active version (``compare="current"``) or from any version
    (``compare="all"``, which re-inserts a version that equals the newest one but differs from an older one).
    """
    src_bk = src_bk or bk
    src_attrs = src_attrs or attrs
    agg = F.min if eff == "min" else F.max
    cand = (
        src.where(F.col(src_bk).isNotNull()).groupBy(F.col(src_bk).alias(bk), *[F.col(s).alias(a) for s, a in zip(src_attrs, attrs)])
        .agg(agg(F.timestamp_seconds(F.col(ts))).alias("row_eff_time"))
    )
    if compare == "history":
        sk = next(c for c in target.columns if c not in (bk, *attrs, *SCD2_COLUMNS))
        told, _, _ = _history(target, _sightings(src, bk, attrs, ts, src_bk, src_attrs), bk, attrs, sk)
        new = told.where("__new").select(bk, *attrs, "row_eff_time")
    elif compare == "current":
        # at most one Active version per key: a 1:1 left join on the business key
        versions = target.where(F.col("current_row_indicator") == ACTIVE).select(
            F.col(bk).alias("__bk"), *[F.col(a).alias(f"__{a}") for a in attrs])
        joined = cand.join(versions, cand[bk] == versions["__bk"], "left")
        keep = F.col("__bk").isNull() | _distinct_on(attrs, joined, joined, [f"__{a}" for a in attrs])
        new = joined.where(keep).select(*cand.columns)
    elif compare == "all":
        # "differs from at least one version" == the key has more versions than versions equal to the
        # candidate.  Both counts are partial aggregates joined 1:1, so a key with very many versions never
        # pairs each candidate with each of its versions.
        per_key = target.groupBy(F.col(bk).alias("__bk")).agg(F.count(F.lit(1)).alias("__n"))
        per_set = target.groupBy(F.col(bk).alias("__sbk"), *[F.col(a).alias(f"__s_{a}") for a in attrs]).agg(
            F.count(F.lit(1)).alias("__eq"))
        c = cand.join(per_key, cand[bk] == per_key["__bk"], "left")
        c = c.join(per_set, (c[bk] == per_set["__sbk"]) & ~_distinct_on(attrs, c, per_set,
                                                                        [f"__s_{a}" for a in attrs]), "left")
        keep = F.col("__n").isNull() | (F.col("__n") > F.coalesce(F.col("__eq"), F.lit(0)))
        new = c.where(keep).select(*cand.columns)
    else:
        raise ValueError(f"compare must be 'history', 'current' or 'all', not {compare!r}")
    return new.withColumns({
        "row_exp_time": F.lit(None).cast("timestamp"),
        "current_row_indicator": F.lit(ACTIVE),
        "updated_at": F.col("row_eff_time"),
    })


def scd2_expire(target: DataFrame, touched: DataFrame, bk: str, sk: str, recompute: bool = True) -> DataFrame:
    """Close superseded versions of the keys in ``touched`` (a frame with column ``bk``).

    The next newer version's effective time is the key's next version in (effective time, surrogate key)
    order (:func:`successor_value`), so equal effective times are ordered by surrogate key.  ``recompute=True`` rederives expiry and indicator for every version of a
    touched key (correct with late or several versions per batch); ``recompute=False`` only closes versions
    whose expiry is still NULL, as the original statements do.  Returns the whole dimension.
    """
    keys = touched.select(bk).distinct()
    hit = target.join(keys, bk, "left_semi")  # only the touched keys' versions are sorted
    rest = target.join(keys, bk, "left_anti")
    # a key with very many versions is spread over tasks: no window partitioned by the key
    hit = successor_value(hit, bk, ["row_eff_time", sk], "row_eff_time", "__next")
    if recompute:
        hit = hit.withColumns({
            "row_exp_time": F.col("__next"),
            "current_row_indicator": F.when(F.col("__next").isNull(), F.lit(ACTIVE)).otherwise(F.lit(EXPIRED)),
        })
    else:
        close = F.col("row_exp_time").isNull() & F.col("__next").isNotNull()
        hit = hit.withColumns({
            "row_exp_time": F.when(close, F.col("__next")).otherwise(F.col("row_exp_time")),
            "current_row_indicator": F.when(close, F.lit(EXPIRED)).otherwise(F.col("current_row_indicator")),
        })
    return rest.unionByName(hit.drop("__next").select(*target.columns))


def scd2_order_cols(bk: str, attrs: list[str]) -> list[str]:
    """Key order for new versions: business key, effective time, then attributes (unique per version)."""
    return [bk, "row_eff_time", *attrs]


def scd2_apply(target: DataFrame, src: DataFrame, bk: str, attrs: list[str], ts: str, sk: str,
               src_bk: str | None = None, src_attrs: list[str] | None = None,
               compare: str = "history", eff: str = "min", recompute: bool = True) -> DataFrame:
    """Changes -> surrogate keys -> append -> expire, for one batch.  Returns the whole new dimension.  By default all four come
    from one order of the batch's keys; the rules of the original statements run one after the other."""
    if compare == "history" and recompute:
        return _history_apply(target, _sightings(src, bk, attrs, ts, src_bk, src_attrs), bk, attrs, sk)
    changes = scd2_changes(target, src, bk, attrs, ts, src_bk, src_attrs, compare, eff)
    changes = assign_surrogate_keys(changes, scd2_order_cols(bk, attrs), sk, start=_max_key(target, sk))
    merged = target.unionByName(changes.select(*target.columns))
    touched = changes.select(bk) if recompute else src.select(F.col(src_bk or bk).alias(bk))
    return scd2_expire(merged, touched, bk, sk, recompute=recompute)
