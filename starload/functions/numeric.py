"""Numeric scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starload.schemas import MONEY


def round_to_int(x, type_: str = "bigint") -> Column:
    """Round half away from zero, then cast: what storing a numeric into an integer column does.

    A bare cast truncates (2.5 -> 2); ``round`` on a decimal rounds half up in magnitude (2.5 -> 3, -2.5 -> -3).
    Doubles are taken through decimal first so 2.5 is not subject to binary rounding surprises.
    """
    c = F.col(x) if isinstance(x, str) else x
    return F.round(c.cast("decimal(38,6)"), 0).cast(type_)


def to_money(x) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return c.cast(MONEY)
