"""Tumbling extract windows and schema-merging unions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_key(window_start) -> "F.Column":
    """The landing key of a window: its start as ``yyyyMMddHHmm``."""
    c = F.col(window_start) if isinstance(window_start, str) else window_start
    return F.date_format(c, "yyyyMMddHHmm")


def assign_windows(df: DataFrame, epoch_col: str, length: str = "4 hours") -> DataFrame:
    """Add ``window_start`` / ``window_end`` / ``batch`` for tumbling windows aligned to 00:00 UTC."""
    w = F.window(F.timestamp_seconds(F.col(epoch_col)), length)
    return df.withColumn("__w", w).withColumns({
        "window_start": F.col("__w.start"), "window_end": F.col("__w.end"),
        "batch": batch_key(F.col("__w.start")),
    }).drop("__w")


def batch_window(df: DataFrame, epoch_col: str, start: dt.datetime, length: dt.timedelta) -> DataFrame:
    """Rows with ``start <= t < start + length`` (half-open, so consecutive windows never overlap).  A plain
    range predicate on the column, so it reaches the parquet scan as a pushed filter."""
    lo = int(start.replace(tzinfo=dt.timezone.utc).timestamp())
    hi = lo + int(length.total_seconds())
    return df.where((F.col(epoch_col) >= lo) & (F.col(epoch_col) < hi))


def diagonal_union(*frames: DataFrame) -> DataFrame:
    """Concatenate frames by column name; columns missing from a frame are NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
