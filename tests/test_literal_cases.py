"""Small inputs with results written by hand."""

import datetime as dt
import json
import os

from starload.functions.ids import padded_id
from starload.operators.lookup import lookup_asof
from starload.plans.warehouse import empty_warehouse, run_batch
from starload.sources.landing import ingest_orders, ingest_traffic, read_orders, read_traffic
from starload.streaming.ingest import stream_ingest_to_table

T0 = 1_700_000_000  # 2023-11-14
DAY = 86_400


def ts(seconds):
    return dt.datetime.fromtimestamp(seconds, dt.timezone.utc).replace(tzinfo=None)


def test_long_numbers_are_not_cut(spark):
    got = spark.createDataFrame([(7,), (9_999,), (10_000,), (123_456,)], "n long").select(padded_id("S-", "n", 4).alias("x")).collect()
    assert [r.x for r in got] == ["S-0007", "S-9999", "S-10000", "S-123456"]


def test_asof_gives_one_row_for_each_fact(spark):
    """Versions x and y begin at the same second, z is a replay with an open end: y counts before and at the start."""
    versions = [(1, "k", ts(100), ts(100)), (2, "k", ts(100), None), (3, "k", ts(200), None), (4, "other", ts(0), None)]
    dim = spark.createDataFrame(versions, "sk long, bk string, row_eff_time timestamp, row_exp_time timestamp")
    facts = spark.createDataFrame([(i, "k", ts(t)) for i, t in enumerate([50, 100, 199, 200, 900])] + [(9, "none", ts(1)), (10, None, ts(1))], "id long, bk string, at timestamp")
    got = {r.id: r.sk for r in lookup_asof(facts, dim.withColumnRenamed("bk", "dim_bk"), "bk", "dim_bk", "sk", "at").collect()}
    assert lookup_asof(facts, dim.withColumnRenamed("bk", "dim_bk"), "bk", "dim_bk", "sk", "at").count() == 7
    assert got == {0: 2, 1: 2, 2: 2, 3: 3, 4: 3, 9: None, 10: None}


def order(oid, at, items):
    return {"order_id": oid, "customer_id": "C1", "order_time": at, "name": "Ann", "latitude": "1.0", "longitude": "2.0", "place": "P", "country": "AT", "updated_at": at,
            "item_list": [{"line_item_id": li, "sku_id": "S1", "product_id": "P1", "product_name": "shirt", "size": "M", "color": "red", "price": "10.00", "cogs": "4.00", "quantity": q} for li, q in items]}


def visit(sid, at, **more):
    return {"session_id": sid, "visit_time": at, "page_views": 3, "session_duration": "12.5", **more}


def land(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(map(json.dumps, records)))


def test_oversized_numbers_are_quarantined(spark, tmp_path):
    land(f"{tmp_path}/o", "a", [order("O1", T0, [("L1", 1)]), order("O2", T0, [("L2", 3_000_000_000)]), order("O3", 10**25, [("L3", 1)])])
    good, bad = ingest_orders(read_orders(spark, f"{tmp_path}/o"))
    assert [r.order_id for r in good.collect()] == ["O1"]
    assert {r.order_id: r.reason for r in bad.collect()} == {"O2": "bad item field", "O3": "bad order_time; bad updated_at"}
    land(f"{tmp_path}/t", "a", [visit("a", T0), visit("b", T0, page_views=9_999_999_999), visit("c", T0, clicks=9_999_999_999)])
    good, bad = ingest_traffic(read_traffic(spark, f"{tmp_path}/t"))
    assert [r.session_id for r in good.collect()] == ["a"]
    assert {r.session_id: r.reason for r in bad.collect()} == {"b": "bad page_views", "c": "bad clicks"}


def test_summary_follows_moved_lines_and_late_sessions(spark, tmp_path):
    def orders(name, records):
        land(f"{tmp_path}/{name}", "a", records)
        return ingest_orders(read_orders(spark, f"{tmp_path}/{name}"))[0]

    def sessions(name, records):
        land(f"{tmp_path}/{name}", "a", records)
        return ingest_traffic(read_traffic(spark, f"{tmp_path}/{name}"))[0]

    w = run_batch(spark, empty_warehouse(spark), orders("o1", [order("O1", T0, [("L1", 1), ("L2", 4)]), order("O2", T0 + DAY, [("L3", 2)])]), sessions("t1", [visit("a", T0)]))
    w = run_batch(spark, w, orders("o2", [order("O1", T0 + 2 * DAY, [("L2", 4)]), order("O2", T0 + 2 * DAY, [("L3", 2)])]), None)
    days = {r.date_id: (int(r.quantity), r.num_sessions) for r in w.fct_periodic_summary.collect()}
    assert days == {20231114: (1, 1), 20231116: (6, 0)}
    w = run_batch(spark, w, None, sessions("t2", [visit("b", T0 + 5), visit("c", T0 + 2 * DAY)]))
    days = {r.date_id: (int(r.quantity), r.num_sessions) for r in w.fct_periodic_summary.collect()}
    assert days == {20231114: (1, 2), 20231116: (6, 1)}


def test_empty_orders_make_no_fact_rows(spark, tmp_path):
    land(f"{tmp_path}/o", "a", [order("O1", T0, [("L1", 1)]), order("O2", T0, []), order("O3", T0, [])])
    lines = ingest_orders(read_orders(spark, f"{tmp_path}/o"))[0]
    w = run_batch(spark, empty_warehouse(spark), lines, None)
    again = run_batch(spark, w, lines, None)
    for state in (w, again):
        assert [(r.line_item_id, r.order_id) for r in state.fct_sales.collect()] == [("L1", "O1")]
        assert state.dim_sku.count() == 1
    assert sorted(r.order_id for r in w.quarantine_sales.collect()) == ["O2", "O3"]


def test_stream_merges_within_and_across_micro_batches(spark, tmp_path):
    source, base = f"{tmp_path}/in", f"{tmp_path}/table"
    land(source, "1", [visit("a", T0, clicks=1), visit("a", T0 + 9, clicks=2), visit("b", T0)])
    first = {r.session_id: r.clicks for r in stream_ingest_to_table(spark, source, base).collect()}
    land(source, "2", [visit("a", T0 + 20, clicks=9), visit("c", T0)])
    stream_ingest_to_table(spark, source, base)
    land(source, "3", [visit("b", T0 + 1, clicks=5)])
    got = stream_ingest_to_table(spark, source, base)
    assert first == {"a": 2, "b": 0}
    assert sorted((r.session_id, r.clicks) for r in got.collect()) == [("a", 9), ("b", 5), ("c", 0)]
