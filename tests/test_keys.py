from pyspark.sql import Window
from pyspark.sql import functions as F

from starload.operators.keys import assign_surrogate_keys


def test_keys_equal_row_number(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).cast("string").alias("k"))
    got = assign_surrogate_keys(df, ["k"], "sk", num_partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("k")))
    j = got.join(ref, "k")
    assert j.count() == 5000
    assert j.where(F.col("sk") != F.col("rn")).count() == 0


def test_keys_start_and_empty(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    got = {r.k: r.sk for r in assign_surrogate_keys(df, ["k"], "sk", start=10).collect()}
    assert got == {"a": 11, "b": 12, "c": 13}
    e = df.where("false")
    assert assign_surrogate_keys(e, ["k"], "sk", start=spark.range(1).selectExpr("cast(5 as bigint)")).count() == 0


def test_keys_null_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    got = sorted((r.sk, r.k) for r in assign_surrogate_keys(df, ["k"], "sk").collect())
    assert got == [(1, None), (2, "a"), (3, "b")]


def test_keys_with_adaptive_partitions(spark):
    """Default path: AQE decides how many range partitions to keep; keys must still equal row_number."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        df = spark.range(20000).select((F.col("id") * 7919 % 20011).cast("string").alias("k"))
        got = assign_surrogate_keys(df, ["k"], "sk")
        ref = df.withColumn("rn", F.row_number().over(Window.orderBy("k")))
        assert got.join(ref, "k").where(F.col("sk") != F.col("rn")).count() == 0
        assert got.select("sk").distinct().count() == 20000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def test_successor_value_matches_lead(spark):
    from starload.operators.keys import successor_value

    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        # group 'HOT' holds a third of the rows and spans many range partitions
        df = spark.range(6000).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 97).cast("string")).alias("g"),
            ((F.col("id") * 7919) % 6007).alias("t"), F.col("id").alias("sk"))
        got = successor_value(df, "g", ["t", "sk"], "t", "nxt")
        ref = df.withColumn("ref", F.lead("t").over(Window.partitionBy("g").orderBy("t", "sk")))
        j = got.join(ref, ["g", "t", "sk"])
        assert j.count() == 6000
        assert j.where(~F.col("nxt").eqNullSafe(F.col("ref"))).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def test_carry_forward_matches_a_window(spark):
    from starload.operators.keys import carry_forward

    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        # 'HOT' holds a third of the rows, a null group some; most rows carry nothing, and 'HOT' carries its first row only
        df = spark.range(6000).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 11 > 0, (F.col("id") % 97).cast("string")).alias("g"),
            F.when(F.col("id") % 50 > 0, (F.col("id") * 7919) % 6007).alias("t"), F.col("id").alias("sk"))
        value = F.when(F.when(F.col("g") == "HOT", F.col("sk") == 0).otherwise(F.col("sk") % 5 == 0), F.col("sk"))
        got = carry_forward(df, "g", ["t", "sk"], value, "seen")
        before = Window.partitionBy("g").orderBy("t", "sk").rowsBetween(Window.unboundedPreceding, -1)
        ref = df.withColumn("ref", F.last(value, ignorenulls=True).over(before)).select("sk", "ref")
        j = got.join(ref, "sk")
        assert got.columns == ["g", "t", "sk", "seen"] and j.count() == 6000
        assert j.where(~F.col("seen").eqNullSafe(F.col("ref"))).count() == 0
        assert j.where("g = 'HOT' and seen is not null").count() > 1900
        assert carry_forward(df.where("false"), "g", ["t", "sk"], value, "seen").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
