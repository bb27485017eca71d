"""What is moved, written and put into one task, for rows as they usually are: few repeats, few changes."""

import json
import os

from pyspark.sql import functions as F

from starload.operators import dims, lookup, merge
from starload.operators.merge import dedupe_latest, dedupe_stored
from starload.operators.nested import nest_orders
from starload.plans import deltas, warehouse
from starload.plans.constraints import check_warehouse
from starload.plans.summary import build_periodic_summary
from starload.plans.warehouse import empty_warehouse, run_batch
from starload.schemas import DIM_CUSTOMER, RAW_ORDER, STG_TRAFFIC, empty_frame
from starload.sources import bindings
from starload.sources.landing import land, parse_lines, read_traffic
from starload.streaming import ingest
from test_constraints import SOUND
from test_landing import order


def test_one_batch_without_a_sort_column_is_landed_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "one-batch")
    n = 20000
    rows = spark.range(n).select(F.sha2(F.col("id").cast("string"), 512).alias("session_id"), F.lit("1").alias("visit_time"), F.lit("000000000000").alias("batch"))
    with_settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    for k, v in with_settings.items():
        spark.conf.set(k, v)
    try:
        land(rows, path)
    finally:
        for k in with_settings:
            spark.conf.unset(k)
    files = [f for f in os.listdir(f"{path}/batch=000000000000") if f.startswith("part-")]
    assert len(files) > 1 and all(f.endswith(".json.gz") for f in files)
    assert read_traffic(spark, path).select("session_id").distinct().count() == n


def test_only_rows_of_repeated_keys_are_reduced(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "p"), (None, 3, "q")], "k string, t int, v string")
    assert sorted(map(str, dedupe_stored(df, ["k"], "t").collect())) == sorted(map(str, dedupe_latest(df, ["k"], "t").collect()))
    once = df.where("k = 'b'")
    assert dedupe_stored(once, ["k"], "t") is once


def test_sightings_of_keys_that_never_change_are_not_ordered(spark, monkeypatch):
    ordered = []
    real = dims.range_ordered
    monkeypatch.setattr(dims, "range_ordered", lambda df, cols: ordered.append(df.count()) or real(df, cols))
    seen = [("c1", "A", 100 + k) for k in range(50)] + [("c2", "A" if k % 2 else "B", 100 + k) for k in range(4)]
    src = spark.createDataFrame(seen, "customer_id string, name string, updated_at long")
    out = warehouse.load_customer(empty_frame(spark, DIM_CUSTOMER), src)
    assert ordered == [5]
    got = [(r.customer_bk, r.customer_name, r.row_eff_time.timestamp(), r.current_row_indicator) for r in out.orderBy("customer_id").collect()]
    assert got == [("c1", "A", 100, "Active"), ("c2", "B", 100, "Expired"), ("c2", "A", 101, "Expired"), ("c2", "B", 102, "Expired"), ("c2", "A", 103, "Active")]
    # again, with an earlier sighting of the one that never changed: it begins a version, as before
    early = spark.createDataFrame([("c1", "A", 50), ("c1", "A", 100), ("c1", "A", 200)], src.schema)
    again = warehouse.load_customer(out, early).where("customer_bk = 'c1'").orderBy("row_eff_time").collect()
    assert [r.row_eff_time.timestamp() for r in again] == [50, 100]


def test_as_of_order_holds_only_keys_with_several_versions(spark, monkeypatch):
    held = []
    real = lookup.carry_forward
    monkeypatch.setattr(lookup, "carry_forward", lambda df, *a: held.append(df.where("__is_fact").count()) or real(df, *a))
    dim = spark.createDataFrame([("a", 1, 10), ("b", 2, 10), ("b", 3, 20)], "bk string, sk long, e long").withColumn("row_eff_time", F.timestamp_seconds("e")).drop("e")
    facts = spark.createDataFrame([(1, "a", 5), (2, "a", None), (3, "b", 5), (4, "b", 25), (5, "z", 5), (6, None, 5)], "id int, k string, t long").withColumn("at", F.timestamp_seconds("t"))
    got = {r.id: r.sk for r in lookup.lookup_asof(facts, dim, "k", "bk", "sk", "at").collect()}
    assert got == {1: 1, 2: None, 3: 2, 4: 3, 5: None, 6: None} and held == [2]


def test_first_batch_is_not_written_twice(spark, monkeypatch):
    names = []
    real = warehouse.materialize
    monkeypatch.setattr(warehouse, "materialize", lambda df, name="table": names.append(name) or real(df, name))
    row = ("s1", 1704067200, 3, 1.5, 0, "Paid", "-", "Desktop", "x", "y", 0)
    visits = spark.createDataFrame([row, ("s2", *row[1:])], "session_id string, visit_time long, page_views int, d double, clicks int, traffic_source string, referral_source string, device string, os string, browser string, transactions int")
    visits = visits.withColumnRenamed("d", "session_duration").select(*[F.col(f.name).cast(f.dataType) for f in STG_TRAFFIC.fields])
    w = run_batch(spark, empty_warehouse(spark), None, visits, summary=False)
    assert w.fct_traffic.count() == 2 and "fct_traffic_batch" in names and "fct_traffic" not in names


def test_stream_keeps_the_text_of_rejected_orders_only(spark):
    texts = [json.dumps(order()), json.dumps(order(order_id="O2", item_list=[])), "{broken"]
    lines = spark.createDataFrame([(t, "b", "f") for t in texts], "value string, batch string, source_file string")
    kept = ingest._validated(parse_lines(lines, RAW_ORDER)).collect()
    assert [(r.raw_record, r.reason.split(";")[0]) for r in kept] == [(None, ""), (texts[1], "no line"), (texts[2], "malformed record")]


def test_customers_join_orders_before_lines(spark, tmp_path):
    tables = {"lineitem": "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double", "orders": "o_orderkey long, o_custkey long",
              "customer": "c_custkey long, c_name string, c_nationkey int", "nation": "n_nationkey int, n_name string, n_regionkey int", "region": "r_regionkey int, r_name string",
              "part": "p_partkey long, p_brand string, p_name string, p_size int, p_type string, p_retailprice double"}
    for name, columns in tables.items():
        spark.createDataFrame([], columns).write.parquet(str(tmp_path / f"{name}.parquet"))
    plan = bindings.stg_orders(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan[plan.index("(o_custkey"):]


def test_lines_of_an_order_are_not_moved_again_to_be_nested(spark, tmp_path):
    n = 4000
    ids = spark.range(n)
    tables = {"lineitem": spark.range(3 * n).selectExpr("id % 4000 as l_orderkey", "cast(id / 4000 as int) as l_linenumber", "id % 4000 as l_partkey", "1L as l_suppkey", "2.0D as l_quantity"),
              "orders": ids.selectExpr("id as o_orderkey", "id as o_custkey"), "customer": ids.selectExpr("id as c_custkey", "md5(string(id)) as c_name", "0 as c_nationkey"),
              "nation": spark.sql("select 0 as n_nationkey, 'N' as n_name, 0 as n_regionkey"), "region": spark.sql("select 0 as r_regionkey, 'R' as r_name"),
              "part": ids.selectExpr("id as p_partkey", "md5(string(id)) as p_brand", "md5(string(-id)) as p_name", "1 as p_size", "'T' as p_type", "1.5D as p_retailprice")}
    for name, rows in tables.items():
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")  # only nations are small
    try:
        nested = nest_orders(bindings.stg_orders(spark, str(tmp_path)))
        rows = nested.collect()
        plan = nested._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(rows) == n and {len(r.item_list) for r in rows} == {3}
    assert "SortMergeJoin" in plan and "hashpartitioning(order_id" not in plan


def test_only_rows_of_days_with_repeats_are_moved_to_find_them(spark, monkeypatch):
    held = {}
    real = merge.materialize
    monkeypatch.setattr(merge, "materialize", lambda df, name="table": held.setdefault(name, real(df, name)))
    rows = [(f"k{i}", i % 10, i) for i in range(100)] + [("k3", 3, 500), ("k3", 5, 400), ("k13", 3, 0), ("k77", 7, 7), (None, None, 1), (None, None, 2), ("x", None, 3)]
    df = spark.createDataFrame(rows, "k string, day long, v long")
    got = dedupe_stored(df, ["k"], "v", F.col("day") + 64 * 1000)
    assert sorted(map(str, got.collect())) == sorted(map(str, dedupe_latest(df, ["k"], "v").collect()))
    assert {r.day for r in held["once"].select("day").distinct().collect()} <= {None, 0, 3, 5, 7}
    assert held["once"].where("day = 5").count() == 10 and held["once"].where("day = 4").count() == 0


def test_as_of_rows_of_one_version_are_told_apart_by_a_small_table(spark):
    dim = spark.createDataFrame([("a", 1, 10), ("b", 2, 10), ("b", 3, 20)], "bk string, sk long, e long").withColumn("row_eff_time", F.timestamp_seconds("e")).drop("e")
    facts = spark.createDataFrame([(1, "a", 5), (2, "b", 25), (3, "b", None)], "id int, k string, t long")
    got = lookup.lookup_asof(facts, dim, "k", "bk", "sk", F.timestamp_seconds("t"))
    assert {r.id: r.sk for r in got.collect()} == {1: 1, 2: 3, 3: None}
    assert "LeftAnti" in got._jdf.queryExecution().optimizedPlan().toString()


def test_distinct_counts_of_days_move_distinct_pairs_only(spark):
    sales = spark.createDataFrame([(20240101, "o1", 1, 2, 1.5, 0.5), (20240101, "o1", 2, 1, 1.0, 0.5), (20240101, None, 3, 1, 1.0, 0.5), (20240102, None, None, 1, 1.0, None)],
                                  "order_date_id int, order_id string, customer_id long, quantity int, revenue double, gross_profit double")
    traffic = spark.createDataFrame([("s1", 20240101, 3, 1.0, 1, 0), ("s1", 20240101, 1, 1.0, 0, 0), (None, 20240101, 1, 1.0, 0, 0)],
                                    "session_id string, visit_date_id int, page_views int, session_duration double, clicks int, transactions int")
    customers = spark.createDataFrame([(1, "c"), (2, "c"), (3, "d")], "customer_id long, customer_bk string")
    out = build_periodic_summary(sales, traffic, [20240101, 20240102], customers)
    plan = out._jdf.queryExecution().executedPlan().toString()
    got = {r.date_id: (r.unique_orders, r.unique_customers, r.quantity, r.num_sessions, r.page_views) for r in out.collect()}
    assert got == {20240101: (1, 2, 4, 1, 5), 20240102: (0, 0, 1, 0, None)}
    assert "Expand" not in plan


def test_lines_that_go_to_their_parts_carry_one_order_key(spark, tmp_path):
    test_customers_join_orders_before_lines(spark, tmp_path)
    plan = bindings.stg_orders(spark, str(tmp_path), parts_last=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" not in plan[:plan.index("p_partkey")]


def test_rules_are_counted_by_number(spark):
    tables = {t: spark.createDataFrame(rows, schema) for t, (schema, rows) in SOUND.items()}
    plan = check_warehouse(tables)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(no" in plan and "hashpartitioning(table" not in plan


def test_a_batch_of_deltas_finds_its_replaced_lines_once(spark, monkeypatch):
    held = []
    real = deltas.materialize
    monkeypatch.setattr(deltas, "materialize", lambda df, name="table": held.append(name) or real(df, name))
    sales = spark.createDataFrame([(20240101, "o1", 1, 2, 1.5, 0.5, 1), (20240101, "o1", 2, 1, 1.0, 0.5, 1), (20240101, None, None, 1, 1.0, 0.5, 1)],
                                  "order_date_id int, order_id string, customer_id long, quantity int, revenue double, gross_profit double, sign int")
    customers = spark.createDataFrame([(1, "c"), (2, "c")], "customer_id long, customer_bk string")
    days, counts = deltas.change_days(empty_frame(spark, deltas.DAY_STATE), empty_frame(spark, deltas.VALUE_STATE), sales, None, customers, [20240101])
    row = days.first()
    assert (row.lines, row.unique_orders, row.unique_customers, row.quantity) == (3, 1, 1, 4)
    assert sorted((r.kind, r.value, r.n) for r in counts.collect()) == [("customer", "c", 2), ("order", "o1", 2)]
    assert held == ["signed_sales", "tally"]
