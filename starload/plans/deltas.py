"""The daily summary by deltas: what a batch inserts, replaces and moves changes the totals of its days, and no other row is read.

Sums and counts of rows change by plain addition.  Distinct counts need to know how many rows still have a value: the state holds a
reference count for each (day, kind, value), partitioned by day.  A value is counted while its reference count is above zero, so
replacing a line, moving it to another day and back, or loading a batch again all end where a rebuild would.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.operators.merge import in_parts
from starload.plans.summary import customer_business_keys
from starload.schemas import FCT_PERIODIC_SUMMARY
from starload.session import materialize

# Additive totals of a day, and what is counted distinctly.
SALES_SUMS, TRAFFIC_SUMS = ("quantity", "revenue", "gross_profit"), ("page_views", "session_duration", "clicks", "transactions")
COUNTED = {"order": "unique_orders", "customer": "unique_customers"}
DAY_STATE = T.StructType([T.StructField("date_id", T.IntegerType()), T.StructField("lines", T.LongType()), T.StructField("visits", T.LongType()),
                          *[T.StructField(c, T.LongType()) for c in COUNTED.values()], *[FCT_PERIODIC_SUMMARY[c] for c in (*SALES_SUMS, *TRAFFIC_SUMS)]])
VALUE_STATE = T.StructType([T.StructField("date_id", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("value", T.StringType()),
                            T.StructField("n", T.LongType())])


def signed_rows(before: DataFrame, batch: DataFrame, key: str, part: str, parts: list) -> DataFrame:
    """A merge of ``batch`` (one row a key) into ``before`` as changes: its rows with ``sign`` 1, and the rows that they replace with
    -1.  Only the partitions ``parts``, which the merge touches, are read."""
    old = before.where(in_parts(part, parts)).join(batch.select(key), key, "left_semi").select(*batch.columns)
    return batch.withColumn("sign", F.lit(1)).unionByName(old.withColumn("sign", F.lit(-1)))


def _totals(changes: DataFrame, day: str, sums: tuple[str, ...], rows: str) -> DataFrame:
    added = [F.sum(F.col(c) * F.col("sign")).cast(DAY_STATE[c].dataType).alias(c) for c in sums]
    return changes.groupBy(F.col(day).alias("date_id")).agg(F.sum("sign").cast("long").alias(rows), *added)


def change_days(days: DataFrame, values: DataFrame, sales: DataFrame | None, traffic: DataFrame | None,
                dim_customer: DataFrame, touched: list) -> tuple[DataFrame, DataFrame]:
    """The state after a batch: (one row a day, the reference counts of the touched days).

    ``days`` and ``values`` are the state before, ``sales`` and ``traffic`` the signed rows of the facts (:func:`signed_rows`) or None, and
    ``touched`` the days that they are on.  Customers are counted by business key.
    """
    parts = []
    counts = values.where(in_parts("date_id", touched))
    if sales is not None:
        # the rows that a batch replaces are found once; per value they are summed before customers get their keys
        sales = materialize(sales.select("order_date_id", "order_id", "customer_id", *SALES_SUMS, "sign"), "signed_sales")
        parts.append(_totals(sales, "order_date_id", SALES_SUMS, "lines"))
        n = F.sum("sign").cast("long").alias("n")
        by_order = sales.groupBy(F.col("order_date_id").alias("date_id"), F.lit("order").alias("kind"), F.col("order_id").alias("value")).agg(n)
        by_customer = customer_business_keys(sales.groupBy(F.col("order_date_id").alias("date_id"), "customer_id").agg(n), dim_customer)
        moved = by_order.unionByName(by_customer.select("date_id", F.lit("customer").alias("kind"), F.col("customer_bk").alias("value"), "n"))
        # both sides are reduced to one row a value before they meet; a hot order or customer is summed map-side
        tally = counts.withColumn("old", F.col("n")).unionByName(moved.where("value is not null").withColumn("old", F.lit(0).cast("long")))
        tally = tally.groupBy("date_id", "kind", "value").agg(F.sum("n").alias("n"), F.sum("old").alias("old"))
        tally = materialize(tally, "tally")
        gained = F.when((F.col("n") > 0) & (F.col("old") == 0), 1).when((F.col("n") == 0) & (F.col("old") > 0), -1).otherwise(0)
        each = [F.sum(F.when(F.col("kind") == k, gained).otherwise(0)).cast("long").alias(c) for k, c in COUNTED.items()]
        parts.append(tally.groupBy("date_id").agg(*each))
        counts = tally.where("n > 0").select(*VALUE_STATE.names)
    if traffic is not None:
        parts.append(_totals(traffic, "visit_date_id", TRAFFIC_SUMS, "visits"))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [days, *parts])
    added = [F.coalesce(F.sum(f.name), F.lit(0)).cast(f.dataType).alias(f.name) for f in DAY_STATE.fields[1:]]
    # one row a day and part: a few thousand
    return every.groupBy("date_id").agg(*added).where("lines > 0 or visits > 0").select(*DAY_STATE.names), counts


def summary_of(days: DataFrame, include: str = "orders") -> DataFrame:
    """The summary that the state stands for: days with lines, or (``include="either"``) all of them; as a rebuild gives it."""
    of_sales = [F.when(F.col("lines") > 0, F.col(c)).alias(c) for c in SALES_SUMS]
    of_visits = [F.when(F.col("visits") > 0, F.col(c)).alias(c) for c in TRAFFIC_SUMS]
    shown = days if include == "either" else days.where("lines > 0")
    return shown.select("date_id", *COUNTED.values(), *of_sales, *of_visits, F.col("visits").alias("num_sessions")).select(*FCT_PERIODIC_SUMMARY.names)
