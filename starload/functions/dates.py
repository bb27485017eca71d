"""Date and time scalars: epoch conversion, yyyymmdd ids, calendar attributes and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_timestamp(epoch) -> Column:
    """Epoch seconds -> timestamp (session time zone is UTC)."""
    return F.timestamp_seconds(_c(epoch))


def date_id(ts) -> Column:
    """yyyymmdd as int from a date or timestamp; integer arithmetic instead of formatting and parsing."""
    c = _c(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def weekend_label(day_of_week) -> Column:
    """ISO day of week (Mon=1 .. Sun=7) -> 'Weekend' for 6 and 7, else 'Weekday'."""
    return F.when(_c(day_of_week).isin(6, 7), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def holiday_label(flag) -> Column:
    return F.when(_c(flag), F.lit("Holiday")).otherwise(F.lit("Non-Holiday"))


def strip_dashes(text) -> Column:
    return F.replace(_c(text), F.lit("-"), F.lit(""))


def calendar_attributes(d) -> dict[str, Column]:
    """The calendar columns of a date, in one ``withColumns`` map."""
    c = _c(d)
    dow = (F.weekday(c) + 1).cast("short")  # weekday(): Mon=0 .. Sun=6
    return {
        "date_id": date_id(c),
        "full_date_description": F.date_format(c, "EEEE, d MMMM yyyy"),
        "year": F.year(c).cast("short"),
        "quarter": F.quarter(c).cast("short"),
        "month": F.month(c).cast("short"),
        "day": F.dayofmonth(c).cast("short"),
        "day_of_week": dow,
        "calendar_day_of_week": F.date_format(c, "EEEE"),
        "calendar_month": F.date_format(c, "MMMM"),
        "is_weekend": weekend_label(dow),
    }
