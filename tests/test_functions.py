import datetime as dt

from pyspark.sql import functions as F

from starload.functions.dates import calendar_attributes, date_id
from starload.functions.ids import time_ordered_id
from starload.functions.numeric import round_to_int
from starload.plans.calendar import build_dim_date


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (44.97,), (0.49,)], "x double")
    got = [r[0] for r in df.select(round_to_int("x", "int")).collect()]
    assert got == [3, -3, 45, 0]


def test_sunday(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 4),)], "d date")
    r = df.select(*[c.alias(n) for n, c in calendar_attributes(F.col("d")).items()]).first()
    assert r.full_date_description == "Sunday, 4 February 2024"
    assert r.day_of_week == 7 and r.is_weekend == "Weekend" and r.date_id == 20240204
    assert r.calendar_day_of_week == "Sunday" and r.calendar_month == "February" and r.quarter == 1


def test_calendar_size_and_sentinels(spark):
    cal = build_dim_date(spark, dt.date(2020, 1, 1), dt.date(2030, 1, 1))
    assert cal.count() == 3653 + 2
    s = {r.date_id: r for r in cal.where("date_id < 0").collect()}
    assert s[-1].full_date_description == "Not Entered" and s[-2].full_date_description == "Error"
    assert s[-1].is_weekend is None and s[-1].event_name is None and s[-1].is_holiday is None
    first = cal.where("date_id = 20200101").first()
    assert first.event_name == "-" and first.is_holiday == "Non-Holiday" and first.is_weekend == "Weekday"


def test_date_id_epoch(spark):
    df = spark.createDataFrame([(1704067199,), (1704067200,)], "t long")
    assert [r[0] for r in df.select(date_id(F.timestamp_seconds("t"))).collect()] == [20231231, 20240101]


def test_time_ordered_id_sorts_by_time(spark):
    df = spark.createDataFrame([(1000, "a"), (2000, "a"), (1000 * 2**40, "b")], "ms long, k string")
    ids = [r[0] for r in df.select(time_ordered_id("ms", "k")).collect()]
    assert all(len(i) == 26 for i in ids)
    assert ids == sorted(ids)
    assert set("".join(i[:10] for i in ids)) <= set("0123456789ABCDEFGHJKMNPQRSTVWXYZ")
