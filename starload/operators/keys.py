"""Order over range partitions: dense keys, and values of the rows before and behind.

``row_number() OVER (ORDER BY ...)`` without a partition moves every row into one task, and a window partitioned by a hot key moves
that key's rows into one.  Instead rows are range-partitioned on the whole order, and the partition of each row is written to the
shared checkpoint folder, so it is fixed even if a task is retried on another executor.  Inside a partition windows and positions
do the work; what crosses the borders (counts, the last or first value) is a frame of one row a partition, which is summed or
carried in order and joined back by broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.session import checkpoint_dir, materialize

_PID = "__sk_pid"
_MID = "__sk_mid"
_NONE_BEFORE = (Window.unboundedPreceding, -1)


def _sort_cols(order_cols) -> list[Column]:
    out = []
    for c in order_cols:
        out.append(F.col(c).asc_nulls_first() if isinstance(c, str) else c)
    return out


def _by_partition(per_partition: DataFrame) -> DataFrame:
    """One row a partition: bounded by the number of shuffle partitions, so it is broadcast."""
    return F.broadcast(per_partition.withColumnRenamed(_PID, "__bpid"))


def _with(fixed: DataFrame, per_partition: DataFrame) -> DataFrame:
    return fixed.join(_by_partition(per_partition), F.col(_PID) == F.col("__bpid"), "left").drop("__bpid")


def assign_surrogate_keys(df: DataFrame, order_cols, name: str, start=0, num_partitions: int | None = None
                          ) -> DataFrame:
    """Add a dense ``bigint`` key ``name`` = start + 1, start + 2, ... in ``order_cols`` order: equal to
    ``start + row_number() OVER (ORDER BY order_cols)`` when ``order_cols`` is unique per row.

    ``start`` may be an int or a one-row, one-column DataFrame (e.g. ``max(sk)`` of the target), which is
    evaluated once.  A row's position in its sorted partition is ``monotonically_increasing_id`` without the partition.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    cols = _sort_cols(order_cols)
    # Without an explicit count AQE sizes the range partitions from the data (it merges adjacent ranges, so
    # the order survives): a 25-row dimension gets one partition, a billion keys get thousands.
    ranged = (
        (df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols))
        .sortWithinPartitions(*cols)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_MID, F.monotonically_increasing_id())
    )
    fixed = materialize(ranged, "keys")
    position = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    keyed = _with(fixed, _offsets(fixed.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))))
    return keyed.withColumn(name, start_value(start) + F.col("__offset") + position + 1).drop(_PID, _MID, "__offset")


def start_value(start) -> Column:
    """What keys start from: an int, or the value of a one-row frame."""
    if isinstance(start, DataFrame):
        row = start.first()
        start = int(row[0]) if row is not None and row[0] is not None else 0
    return F.lit(start).cast("bigint")


def _offsets(counts: DataFrame) -> DataFrame:
    """(partition, __n) to (partition, __offset): the rows of all partitions before; one row a partition."""
    before = F.sum("__n").over(Window.orderBy(_PID).rowsBetween(*_NONE_BEFORE))
    return counts.select(_PID, F.coalesce(before, F.lit(0)).cast("bigint").alias("__offset"))


def range_ordered(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """``df`` with the number of the range partition that holds each row in ``order_cols`` order, written down."""
    checkpoint_dir(df.sparkSession)
    return materialize(df.repartitionByRange(*_sort_cols(order_cols)).withColumn(_PID, F.spark_partition_id()), "ordered")


def count_before(fixed: DataFrame, order_cols: list[str], flag: Column, out: str) -> DataFrame:
    """Add ``out`` = the number of rows before this one, in the whole order, where ``flag`` holds."""
    here = F.sum(F.when(flag, 1).otherwise(0)).over(Window.partitionBy(_PID).orderBy(*_sort_cols(order_cols)).rowsBetween(*_NONE_BEFORE))
    told = _with(fixed.withColumn(out, F.coalesce(here, F.lit(0))), _offsets(fixed.groupBy(_PID).agg(F.count_if(flag).alias("__n"))))
    return told.withColumn(out, F.col("__offset") + F.col(out)).drop("__offset")


def nearest_value(fixed: DataFrame, group: str, order_cols: list[str], value: Column, out: str, behind: bool = False) -> DataFrame:
    """Add ``out`` = the non-null ``value`` of the nearest row of the same ``group`` before each row (``behind``: behind it) in the
    order of (group, order_cols), NULL if there is none; ``fixed`` is :func:`range_ordered` by these.

    The value nearest in the whole order is taken together with its group and dropped if that is another one, so no window is
    partitioned by the group, and a group of any size is spread over its partitions."""
    order = [group, *order_cols]
    cols = [F.col(c).desc_nulls_last() if behind else F.col(c).asc_nulls_first() for c in order]
    seen = F.when(value.isNotNull(), F.struct(F.col(group).alias("g"), value.alias("v")))
    here = F.last(seen, ignorenulls=True).over(Window.partitionBy(_PID).orderBy(*cols).rowsBetween(*_NONE_BEFORE))
    place = F.when(value.isNotNull(), F.struct(*order))
    edge = (F.min_by if behind else F.max_by)(seen, place).alias("__edge")
    pid = F.col(_PID).desc() if behind else F.col(_PID).asc()
    across = fixed.groupBy(_PID).agg(edge).select(_PID, F.last("__edge", ignorenulls=True).over(Window.orderBy(pid).rowsBetween(*_NONE_BEFORE)).alias("__across"))
    told = _with(fixed.withColumn("__here", here), across).withColumn("__found", F.coalesce("__here", "__across"))
    return told.withColumn(out, F.when(F.col("__found.g").eqNullSafe(F.col(group)), F.col("__found.v"))).drop("__here", "__across", "__found")


def carry_forward(df: DataFrame, group: str, order_cols: list[str], value: Column, out: str) -> DataFrame:
    """Add ``out`` = the latest non-null ``value`` among the rows of the same ``group`` that stand before a row in ascending
    ``order_cols`` order (nulls first; NULL if there is none).  Rows of a group that tie in ``order_cols`` see each other's values
    in no fixed order, unless all of them are null."""
    return nearest_value(range_ordered(df, [group, *order_cols]), group, order_cols, value, out).drop(_PID)


def successor_value(df: DataFrame, group: str, order_cols: list[str], value: str, out: str) -> DataFrame:
    """Add ``out`` = ``value`` of the next row of the same ``group`` in ascending ``order_cols`` order (NULL for the group's last
    row); ``order_cols`` must make rows unique within a group."""
    fixed = range_ordered(df, [group, *order_cols])
    told = nearest_value(fixed, group, order_cols, F.struct(F.col(value).alias("v")), "__succ", behind=True)
    return told.withColumn(out, F.col("__succ.v")).drop("__succ", _PID)
