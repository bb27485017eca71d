"""Seeded, reproducible sampling.

Randomness comes from ``md5(key || seed)``, so a sample is the same on every run and every retry, and the
same hex digest is available to the SQL oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.operators.keys import assign_surrogate_keys


CHUNK = 10_000


def seeded_hash(key, seed) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(k.cast("string"), F.lit(str(seed))))


def hash_int(key, seed, digits: int = 15) -> Column:
    """A non-negative integer from the first ``digits`` hex digits of the seeded md5 (60 bits)."""
    return F.conv(F.substring(seeded_hash(key, seed), 1, digits), 16, 10).cast("bigint")


def random_sample(df: DataFrame, n: int, key: str, seed) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: ``ORDER BY random() LIMIT n`` with a seeded, per-row order.

    Spark plans this as a top-n per partition and a merge of the partial top-n lists (no global sort), so
    it costs one pass over the data and memory proportional to ``n``.
    """
    h = seeded_hash(key, seed)
    return df.withColumn("__h", h).orderBy("__h", key).limit(n).drop("__h")


def sample_table(spark, table: str, n: int, key: str, seed) -> DataFrame:
    """``SELECT * FROM table ORDER BY <seeded random> LIMIT :n`` as a parameterised SQL scan: the table name and
    the sizes are bound as parameters, never spliced into the text."""
    return spark.sql(
        "SELECT * FROM IDENTIFIER(:t) ORDER BY md5(concat(cast(IDENTIFIER(:k) AS STRING), :seed)), "
        "IDENTIFIER(:k) LIMIT :n",
        args={"t": table, "k": key, "seed": str(seed), "n": int(n)})


#: Rounds of the permutation, and how often a position outside the items is permuted again.  The items fill a quarter of the square
#: at least, more than nine tenths of it from 400 items on; a pick that is still outside after all that raises an error.
ROUNDS, WALK = 6, 64


def permuted(position: Column, m: int, key: Column) -> Column:
    """Where a random permutation of 0..m-1, one for each ``key``, puts ``position``.

    A Feistel network over the smallest square of at least ``m`` positions: each round swaps the two halves of a position and adds
    a hash of one to the other, which can be undone, so it is a permutation whatever the hash.  A position that lands outside
    0..m-1 is permuted again until it is inside (cycle walking), which gives a permutation of 0..m-1."""
    side = F.lit(math.isqrt(max(m - 1, 0)) + 1).cast("bigint")

    def added(high: Column, low: Column, i: Column) -> Column:
        drawn = hash_int(F.concat_ws("-", low.cast("string"), i.cast("string"), key), "")
        return F.pmod(high + drawn, side)

    def network(x: Column) -> Column:
        def swap(x: Column, i: Column) -> Column:
            half = F.pmod(x, side)
            return half * side + added(F.floor(x / side).cast("bigint"), half, i)

        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("bigint"), swap)

    # the first pass, after which nearly all positions are inside, is written out: lambdas are interpreted row by row, plain
    # expressions are compiled, and each round's is evaluated once
    high, low = F.floor(position / side).cast("bigint"), F.pmod(position.cast("bigint"), side)
    for i in range(1, ROUNDS + 1):
        high, low = low, added(high, low, F.lit(i))
    first = high * side + low
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, lambda x, _: F.when(x < m, x).otherwise(network(x)))
    found = F.when(first < m, first).otherwise(walked)
    return F.when(found < m, found).otherwise(F.raise_error(F.lit("no position found")).cast("bigint"))


def sample_per_group(groups: DataFrame, items: DataFrame, group_key: str, k_col: str, item_key: str, seed
                     ) -> DataFrame:
    """For every group, ``k`` distinct items (without replacement; ``k`` is capped at the number of items), each set of ``k``
    equally likely, whatever other groups draw.

    Items are numbered once (0..m-1 by key, scalable key assignment).  A group's pick i is the item where the group's own
    permutation puts i (:func:`permuted`), so picks are distinct without looking at each other.  Each group costs ``k`` rows and
    one equi-join on the position; no group is ever crossed with the whole catalogue.
    Output: the group key, ``pick`` (1..k) and the item's columns.
    """
    ranked = assign_surrogate_keys(items, [item_key], "__pos", start=-1)
    m = ranked.count()
    if m == 0:
        return groups.limit(0).select(group_key).withColumn("pick", F.lit(1)).join(
            ranked.drop("__pos"), F.lit(False), "inner")
    k = F.least(F.col(k_col).cast("bigint"), F.lit(m).cast("bigint"))
    # Picks are generated in chunks of CHUNK: first one row per chunk, spread over the cluster, then the picks
    # of each chunk, so a group asking for millions of items is not generated by one task.
    chunks = (groups.select(group_key, k.alias("__k")).where(F.col("__k") > 0)
              .withColumn("__c", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                      F.floor((F.col("__k") - 1) / CHUNK).cast("bigint")))))
    # a number of partitions is given, because chunks are few bytes and much work: merged by size they would be one task
    chunks = chunks.repartition(int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")), group_key, "__c")
    lo = F.col("__c") * CHUNK
    hi = F.least(F.col("__k"), lo + CHUNK) - 1
    key = F.concat_ws("-", F.col(group_key).cast("string"), F.lit(str(seed)))
    picks = (chunks.withColumn("__i", F.explode(F.sequence(lo, hi)))
             .select(group_key, (F.col("__i") + 1).cast("int").alias("pick"), permuted(F.col("__i"), m, key).alias("__pos")))
    return picks.join(ranked, "__pos").drop("__pos")
