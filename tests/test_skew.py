"""Hot keys: one key holding a third of the rows must give whole, correct results (nothing dropped or
capped), and the plans must combine such keys before shuffling."""

from pyspark.sql import functions as F

from starload.operators.dims import insert_ignore
from starload.operators.lookup import lookup_asof
from starload.operators.merge import dedupe_latest, merge_upsert
from starload.operators.sampling import sample_per_group
from starload.plans.summary import build_periodic_summary

T0 = 1704067200


def hot(spark, n=3000):
    """n rows, a third of them on key 'HOT'."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("k"),
        F.col("id").alias("v"), (F.col("id") % 97).alias("t"))


def test_dedupe_hot_key_keeps_latest(spark):
    df = hot(spark)
    got = {r.k: r for r in dedupe_latest(df, ["k"], "t").collect()}
    assert len(got) == 1 + 2000
    hot_rows = [r for r in df.collect() if r.k == "HOT"]
    best = max(hot_rows, key=lambda r: (r.t, r.v))
    assert (got["HOT"].t, got["HOT"].v) == (best.t, best.v)


def test_dedupe_is_partially_aggregated(spark):
    plan = dedupe_latest(hot(spark), ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan  # map-side combine before the exchange


def test_merge_with_hot_duplicated_source_key(spark):
    t = spark.createDataFrame([("HOT", -1, 0)], "k string, v long, t long")
    m = merge_upsert(t, hot(spark), ["k"], order="t")
    assert m.count() == 2001 and m.where("k = 'HOT'").first().v != -1


def test_insert_ignore_hot_source_value(spark):
    e = spark.createDataFrame([], "sk long, k string")
    d = insert_ignore(e, hot(spark), ["k"], "sk")
    assert d.count() == 2001 and d.select("sk").distinct().count() == 2001


def test_summary_hot_day_counts_everything(spark):
    n = 3000
    sales = spark.range(n).select(
        F.col("id").cast("string").alias("line_item_id"), (F.col("id") % 700).cast("string").alias("order_id"),
        (F.col("id") % 50).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, F.lit(20240101)).otherwise(20240102 + F.col("id") % 5).cast("int")
        .alias("order_date_id"),
        F.lit(1).alias("quantity"), F.lit(1).cast("decimal(18,2)").alias("revenue"),
        F.lit(0).cast("decimal(18,2)").alias("gross_profit"))
    traffic = spark.createDataFrame([], "session_id string, visit_date_id int, page_views int, "
                                        "session_duration decimal(18,2), clicks int, transactions int")
    dates = sales.select(F.col("order_date_id").alias("date_id")).distinct()
    s = {r.date_id: r for r in build_periodic_summary(sales, traffic, dates).collect()}
    assert sum(r.quantity for r in s.values()) == n
    assert s[20240101].quantity == 1000


def test_asof_hot_key_with_many_versions(spark):
    # one business key with 40 versions, a month apart; 900 facts on that key
    versions = spark.range(40).select(
        F.col("id").alias("sk"), F.lit("HOT").alias("bk"),
        F.timestamp_seconds(F.lit(T0) + F.col("id") * 30 * 86400).alias("row_eff_time"),
        F.timestamp_seconds(F.lit(T0) + (F.col("id") + 1) * 30 * 86400).alias("row_exp_time"))
    versions = versions.withColumn("row_exp_time", F.when(F.col("sk") == 39, None).otherwise(F.col("row_exp_time")))
    facts = spark.range(900).select(F.lit("HOT").alias("bk"),
                                    F.timestamp_seconds(F.lit(T0) + F.col("id") * 40 * 3600).alias("at"))
    got = lookup_asof(facts, versions, "bk", "bk", "sk", "at").collect()
    assert len(got) == 900
    for r in got:
        expected = min(int((r.at.timestamp() - T0) // (30 * 86400)), 39)
        assert r.sk == expected


def test_sample_per_group_hot_group_is_capped_by_catalogue_only(spark):
    groups = spark.createDataFrame([(1, 10 ** 6)], "g long, k long")
    items = spark.range(50).withColumnRenamed("id", "item")
    s = sample_per_group(groups, items, "g", "k", "item", 1)
    assert s.count() == 50 and s.select("item").distinct().count() == 50


def test_sample_per_group_spans_chunks(spark):
    groups = spark.createDataFrame([(1, 10 ** 9), (2, 3)], "g long, k long")
    items = spark.range(25000).withColumnRenamed("id", "item")
    s = sample_per_group(groups, items, "g", "k", "item", 5)
    one = s.where("g = 1")
    assert one.count() == 25000 and one.select("item").distinct().count() == 25000
    assert one.agg({"pick": "max"}).first()[0] == 25000
    assert s.where("g = 2").count() == 3
