"""Integrity checks.  Each returns the violating rows (empty frame = check passed), never a Python list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count (primary key / unique index)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows where any of ``cols`` is NULL."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def check_foreign_key(child: DataFrame, parent: DataFrame, child_cols: list[str], parent_cols: list[str] | None = None
                      ) -> DataFrame:
    """Child rows with a non-NULL key that has no parent row (``REFERENCES``): a left anti-join."""
    parent_cols = parent_cols or child_cols
    p = parent.select(*[F.col(c).alias(f"__p{i}") for i, c in enumerate(parent_cols)])
    cond = reduce(lambda a, b: a & b, [child[c] == p[f"__p{i}"] for i, c in enumerate(child_cols)])
    nonnull = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_cols])
    return child.where(nonnull).join(p, cond, "left_anti")


def check_accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows whose ``col`` is not NULL and not one of ``values``."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*values))
