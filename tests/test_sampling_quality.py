import datetime as dt
import hashlib
import math

from pyspark.sql import functions as F

from starload.operators.nested import explode_items, nest_orders
from starload.operators.quality import check_accepted_values, check_foreign_key, check_not_null, check_unique
from starload.operators.sampling import permuted, random_sample, sample_per_group
from starload.operators.windowing import assign_windows, batch_window, diagonal_union


def test_random_sample_exact_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r.k for r in random_sample(df, 25, "k", 3).collect()]
    b = [r.k for r in random_sample(df, 25, "k", 3).collect()]
    assert len(a) == 25 and sorted(a) == sorted(b) and len(set(a)) == 25
    assert random_sample(df, 5000, "k", 3).count() == 1000


def test_sample_per_group_distinct(spark):
    groups = spark.createDataFrame([(1, 3), (2, 5), (3, 0), (4, 50)], "g int, k int")
    items = spark.range(7).withColumnRenamed("id", "item")
    s = sample_per_group(groups, items, "g", "k", "item", 11).collect()
    by = {}
    for r in s:
        by.setdefault(r.g, []).append(r.item)
    assert {g: len(v) for g, v in by.items()} == {1: 3, 2: 5, 4: 7}
    assert all(len(set(v)) == len(v) for v in by.values())


def test_picks_are_uniform(spark):
    """20,000 groups draw 2 of 50: all 1,225 pairs come up, about equally often, and so do first picks; also with few items."""
    for m, most in ((50, 1400), (7, 60), (3, 20), (1, 0)):
        groups = spark.range(20000).select(F.col("id").alias("g"), F.lit(2).alias("k"))
        s = sample_per_group(groups, spark.range(m).withColumnRenamed("id", "item"), "g", "k", "item", 5)
        pairs = {tuple(r.p): r.n for r in s.groupBy("g").agg(F.sort_array(F.collect_list("item")).alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()}
        if m == 1:
            assert pairs == {(0,): 20000}
            continue
        cells = m * (m - 1) // 2
        assert len(pairs) == cells and sum(pairs.values()) == 20000
        assert sum((n - 20000 / cells) ** 2 / (20000 / cells) for n in pairs.values()) < most
        first = [r.n for r in s.where("pick = 1").groupBy("item").agg(F.count("*").alias("n")).collect()]
        assert len(first) == m and sum((n - 20000 / m) ** 2 / (20000 / m) for n in first) < m + 5 * (2 * m) ** 0.5


def test_permuted_is_a_permutation(spark):
    for m in (1, 2, 5, 16, 17, 1000):
        got = [r.p for r in spark.range(m).select(permuted(F.col("id"), m, F.lit("key")).alias("p")).collect()]
        assert sorted(got) == list(range(m))


def test_permuted_gives_the_places_of_the_network(spark):
    """Against the network in Python: six rounds, again while the place is outside."""
    def place(x, m, key):
        side = math.isqrt(m - 1) + 1
        for _ in range(65):
            for i in range(1, 7):
                high, low = divmod(x, side)
                drawn = int(hashlib.md5(f"{low}-{i}-{key}".encode()).hexdigest()[:15], 16)
                x = low * side + (high + drawn) % side
            if x < m:
                return x

    for m in (2, 5, 17, 1000):
        got = spark.range(m).select("id", permuted(F.col("id"), m, F.lit("3-7")).alias("p")).collect()
        assert {r.id: r.p for r in got} == {x: place(x, m, "3-7") for x in range(m)}


def test_few_groups_are_drawn_by_many_tasks(spark):
    """Small groups are few bytes, which must not be merged into one task: their picks are the work."""
    groups = spark.range(500).select(F.col("id").alias("g"), F.lit(40).alias("k"))
    s = sample_per_group(groups, spark.range(100).withColumnRenamed("id", "item"), "g", "k", "item", 5)
    s.collect()
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_COL" not in plan


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "x")], "k int, v string")
    assert [r.k for r in check_unique(df, ["k"]).collect()] == [1]
    assert [r.k for r in check_not_null(df, ["v"]).collect()] == [2]
    assert [r.k for r in check_accepted_values(df, "v", ["a", "b"]).collect()] == [3]
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    assert [r.k for r in check_foreign_key(df, parent, ["k"]).collect()] == [3]


def test_nest_explode_roundtrip(spark):
    flat = spark.createDataFrame(
        [("O1", "C", 1, None, None, None, None, None, 5, "L2", "S", "P", "n", "M", "c", 1.0, 0.5, 1),
         ("O1", "C", 1, None, None, None, None, None, 5, "L1", "S", "P", "n", "M", "c", 1.0, 0.5, 2)],
        "order_id string, customer_id string, order_time long, name string, latitude double, longitude double, "
        "place string, country string, updated_at long, line_item_id string, sku_id string, product_id string, "
        "product_name string, size string, color string, price double, cogs double, quantity long")
    n = nest_orders(flat)
    assert n.count() == 1 and [i.line_item_id for i in n.first().item_list] == ["L1", "L2"]
    back = explode_items(n).select(*flat.columns)
    assert sorted(back.collect()) == sorted(flat.collect())


def test_windows_and_union(spark):
    df = spark.createDataFrame([(1704067200 + 4 * 3600 - 1,), (1704067200 + 4 * 3600,)], "t long")
    w = assign_windows(df, "t").collect()
    assert [r.batch for r in w] == ["202401010000", "202401010400"]
    assert batch_window(df, "t", dt.datetime(2024, 1, 1), dt.timedelta(hours=4)).count() == 1
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2,)], "k int")
    u = diagonal_union(a, b).orderBy("k").collect()
    assert [(r.k, r.v) for r in u] == [(1, "x"), (2, None)]
    assert F is not None
