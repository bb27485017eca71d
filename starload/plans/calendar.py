"""Calendar dimension and holiday updates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.dates import calendar_attributes, holiday_label, strip_dashes
from starload.operators.merge import update_from
from starload.schemas import DIM_DATE

# Column defaults of the calendar table and its two sentinel rows.
DEFAULT_EVENT_NAME = "-"
DEFAULT_IS_HOLIDAY = "Non-Holiday"
SENTINELS = [(-1, "Not Entered"), (-2, "Error")]


def build_dim_date(spark: SparkSession, start: dt.date, end: dt.date, sentinels: bool = True) -> DataFrame:
    """One row per day in ``[start, end)`` plus the sentinel rows (-1 'Not Entered', -2 'Error') whose other
    attributes are NULL.  Days come from ``spark.range`` so they are generated in parallel."""
    n = (end - start).days
    days = spark.range(max(n, 0)).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))
    cal = days.withColumns(calendar_attributes(F.col("date"))).withColumns({
        "event_name": F.lit(DEFAULT_EVENT_NAME),
        "is_holiday": F.lit(DEFAULT_IS_HOLIDAY),
    }).select(*DIM_DATE.names)
    if sentinels:
        s = spark.createDataFrame([(k, None, d) + (None,) * 10 for k, d in SENTINELS], DIM_DATE)
        cal = cal.unionByName(s)
    return cal


def date_bounds(df: DataFrame, ts_col: str) -> tuple[dt.date, dt.date]:
    """[first day, last day + 1) of a timestamp column: one aggregate, one row to the driver."""
    r = df.agg(F.min(F.to_date(ts_col)).alias("lo"), F.max(F.to_date(ts_col)).alias("hi")).first()
    return r["lo"], r["hi"] + dt.timedelta(days=1)


def normalise_holidays(raw: DataFrame) -> DataFrame:
    """Landed holiday records -> (date_id, event_name, is_holiday), one row per date.

    Dates lose their dashes and become int ids ('' -> NULL, which matches nothing).  When a date has several
    events the choice is deterministic: a national holiday wins over other events, then the lowest name.
    """
    r = raw.select(
        F.nullif(strip_dashes("event_date"), F.lit("")).try_cast("int").alias("date_id"),
        F.col("event_name"),
        holiday_label(F.coalesce(F.col("is_national_holiday"), F.lit(False))).alias("is_holiday"),
    ).where(F.col("date_id").isNotNull())
    # rank: Holiday (0) before Non-Holiday (1), then name; min over a struct is a partial aggregate
    best = F.min(F.struct(F.when(F.col("is_holiday") == "Holiday", 0).otherwise(1).alias("r"),
                          F.col("event_name").alias("event_name"), F.col("is_holiday").alias("is_holiday")))
    return r.groupBy("date_id").agg(best.alias("b")).select("date_id", "b.event_name", "b.is_holiday")


def apply_holidays(dim_date: DataFrame, raw_holidays: DataFrame) -> DataFrame:
    """``UPDATE dim_date SET is_holiday, event_name FROM events WHERE date_id = event date``."""
    h = normalise_holidays(raw_holidays)
    return update_from(dim_date, h, "date_id", "date_id", {"is_holiday": "is_holiday", "event_name": "event_name"})
