"""Rejected records: kept with their text until they are repaired.

``ingest_orders`` and ``ingest_traffic`` return what they reject; :func:`store_dead_letters` keeps it under the warehouse's root, one
partition for each landing batch, so loading a batch again changes nothing.  :func:`repair_dead_letters` tries the records again,
after a correction of their text or with newer validation rules, hands out what is valid now and keeps the rest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.operators.merge import in_parts
from starload.plans.commits import State, commit, put_partitions, read_table, state
from starload.schemas import DEAD_LETTERS, RAW_ORDER, RAW_VISIT
from starload.session import materialize
from starload.sources.landing import ingest_orders, ingest_traffic, parse_lines

TABLE, PART = "dead_letters", "batch"
# Each feed's record schema, its own key, and what validates it.
FEEDS = {"orders": (RAW_ORDER, "order_id", ingest_orders), "traffic": (RAW_VISIT, "session_id", ingest_traffic)}


def dead_letters(bad: DataFrame, feed: str) -> DataFrame:
    """Rejected records of a feed in the shape of the table."""
    key = FEEDS[feed][1]
    return bad.select(F.lit(feed).alias("feed"), F.col(key).alias("record_key"), "batch", "source_file", "reason", "raw_record")


def add_letters(at: State, letters: DataFrame) -> None:
    """Put rejected records into ``at``, which the caller commits.  A record that is kept already (same feed, file and text) is
    not kept twice; its reason is the latest."""
    spark = letters.sparkSession
    new = materialize(letters.select(*DEAD_LETTERS.names), "letters")
    batches = [r[0] for r in new.select(PART).distinct().collect()]
    if not batches:
        return
    old = read_table(spark, at, TABLE, DEAD_LETTERS).where(in_parts(PART, batches))
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    same = ["feed", "batch", "source_file", "raw_record"]
    last = F.max(F.struct("__new", "reason", "record_key")).alias("__last")
    rows = both.groupBy(*same).agg(last).select(*same, "__last.reason", "__last.record_key").select(*DEAD_LETTERS.names)
    put_partitions(at, TABLE, rows, PART, batches)


def store_dead_letters(spark: SparkSession, root: str, letters: DataFrame) -> State:
    at = state(spark, root).next()
    add_letters(at, letters)
    return commit(spark, at)


def read_dead_letters(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, state(spark, root), TABLE, DEAD_LETTERS)


def repair_dead_letters(spark: SparkSession, root: str, feed: str, fix: Callable[[Column], Column] | None = None) -> DataFrame:
    """Staging rows of the kept records of ``feed`` that are valid after ``fix`` (a function of their text); these are dropped
    from the table, the others stay as they were.  Load the rows before calling this again: they are handed out once."""
    at = state(spark, root)
    schema, _, ingest = FEEDS[feed]
    every = read_table(spark, at, TABLE, DEAD_LETTERS)
    letters = every.where(F.col("feed") == feed).withColumn("value", fix(F.col("raw_record")) if fix else F.col("raw_record"))
    valid, bad = ingest(parse_lines(letters.select("value", "batch", "source_file"), schema))
    valid = materialize(valid, "repaired")
    still = bad.select(F.col("raw_record").alias("__t"), F.col("batch").alias("__b"), F.col("source_file").alias("__s")).distinct()
    # a text that ``fix`` empties is no record any more, and stays
    empty = letters.where(F.coalesce(F.trim("value"), F.lit("")) == "")
    same = F.col("value").eqNullSafe(F.col("__t")) & F.col("batch").eqNullSafe(F.col("__b")) & F.col("source_file").eqNullSafe(F.col("__s"))
    left = letters.join(still, same, "left_semi").unionByName(empty).drop("value").unionByName(every.where(F.col("feed") != feed))
    batches = [r[0] for r in letters.select(PART).distinct().collect()]
    if batches:
        after = at.next()
        put_partitions(after, TABLE, left.where(in_parts(PART, batches)).select(*DEAD_LETTERS.names), PART, batches)
        commit(spark, after)
    return valid
