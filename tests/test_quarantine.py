"""What can't be loaded is kept, stored, and tried again."""

import json

import pytest

from starload.plans import warehouse
from starload.plans.facts import UnresolvedKeyError
from starload.plans.tables import load_warehouse
from starload.plans.warehouse import empty_warehouse, run_batch
from starload.sources.deadletters import dead_letters, read_dead_letters, repair_dead_letters, store_dead_letters
from starload.sources.landing import InvalidRecordError, ingest_orders, ingest_traffic, read_orders, read_traffic

from test_facts_summary import T0, order, orders_df
from test_landing import order as raw_order


def waiting(w):
    return sorted((r.line_item_id, r.name, r.reason, r.attempts) for r in w.quarantine_sales.collect())


def facts(w):
    return sorted((r.line_item_id, r.customer_id) for r in w.fct_sales.collect())


@pytest.fixture(scope="module")
def batches(spark):
    """A line of Ann (L1) is followed by Bea's (L2) under the same customer; Ann comes back with the next batch."""
    return [orders_df(spark, [order("L1", name="Ann", t=T0), order("L2", name="Bea", t=T0 + 10)]),
            orders_df(spark, [order("L3", name="Ann", t=T0 + 20)])]


def test_lines_resolve_when_their_version_arrives(spark, batches):
    w = run_batch(spark, empty_warehouse(spark), batches[0], None)
    assert facts(w) == [("L2", 2)] and waiting(w) == [("L1", "Ann", "no customer version", 1)]
    again = run_batch(spark, w, batches[0], None)
    assert facts(again) == [("L2", 2)] and [x[:3] for x in waiting(again)] == [("L1", "Ann", "no customer version")]
    w = run_batch(spark, again, batches[1], None)
    assert facts(w) == [("L1", 3), ("L2", 2), ("L3", 3)] and waiting(w) == []


def test_quarantine_survives_storing(spark, batches, tmp_path):
    root = str(tmp_path / "wh")
    run_batch(spark, empty_warehouse(spark), batches[0], None, root=root)
    stored = load_warehouse(spark, root)
    assert waiting(stored) == [("L1", "Ann", "no customer version", 1)]
    run_batch(spark, stored, orders_df(spark, [order("L9", cust="C9", t=T0 + 5)]), None, root=root)
    assert waiting(load_warehouse(spark, root)) == [("L1", "Ann", "no customer version", 2)]
    run_batch(spark, load_warehouse(spark, root), batches[1], None, root=root)
    done = load_warehouse(spark, root)
    assert waiting(done) == [] and [x[0] for x in facts(done)] == ["L1", "L2", "L3", "L9"]


def test_newer_line_replaces_the_waiting_one(spark, batches):
    w = run_batch(spark, empty_warehouse(spark), batches[0], None)
    w = run_batch(spark, w, orders_df(spark, [order("L1", name="Bea", qty=7, t=T0 + 30)]), None)
    assert waiting(w) == [] and {r.line_item_id: r.quantity for r in w.fct_sales.collect()} == {"L1": 7, "L2": 1}


def test_order_without_lines_waits_until_lines_arrive(spark):
    empty = orders_df(spark, [(None, "OL1", None, None, None, None, None, None, None, None, "C1", "Ann", "ID", "P", "1.0", "2.0", T0, T0)])
    w = run_batch(spark, run_batch(spark, empty_warehouse(spark), empty, None), empty, None)
    assert [(r.order_id, r.reason) for r in w.quarantine_sales.collect()] == [("OL1", "no line; no SKU version")]
    w = run_batch(spark, w, orders_df(spark, [order("L1", t=T0 + 5)]), None)
    assert waiting(w) == [] and [x[0] for x in facts(w)] == ["L1"]


def test_strict_mode_publishes_nothing(spark, batches, tmp_path):
    root = str(tmp_path / "wh")
    with pytest.raises(UnresolvedKeyError, match="no customer version"):
        run_batch(spark, empty_warehouse(spark), batches[0], None, root=root, on_unresolved="fail")
    assert load_warehouse(spark, root).fct_sales.count() == 0 and load_warehouse(spark, root).dim_customer.count() == 0
    with pytest.raises(ValueError):
        run_batch(spark, empty_warehouse(spark), batches[0], None, on_unresolved="ignore")


def test_dead_letters_keep_their_text_and_can_be_repaired(spark, tmp_path):
    src, root = tmp_path / "src" / "batch=202401010000", str(tmp_path / "wh")
    src.mkdir(parents=True)
    cut, price, good = '{"order_id": "O1", "customer', json.dumps(raw_order(order_id="O2", order_time="soon", extra=1)), json.dumps(raw_order(order_id="O3"))
    (src / "a.json").write_text("\n".join([cut, price, "", good]))
    valid, bad = ingest_orders(read_orders(spark, str(tmp_path / "src")))
    assert [r.order_id for r in valid.collect()] == ["O3"]
    for _ in range(2):  # a batch that is loaded again leaves one letter for each record
        store_dead_letters(spark, root, dead_letters(bad, "orders"))
        kept = {r.raw_record: (r.record_key, r.reason, r.batch, r.source_file.endswith("a.json")) for r in read_dead_letters(spark, root).collect()}
        assert set(kept) == {cut, price} and kept[price] == ("O2", "bad order_time", "202401010000", True)
        assert kept[cut][1].startswith("malformed record")
    src2 = tmp_path / "visits" / "batch=202401010400"
    src2.mkdir(parents=True)
    (src2 / "b.json").write_text("not json")
    store_dead_letters(spark, root, dead_letters(ingest_traffic(read_traffic(spark, str(tmp_path / "visits")))[1], "traffic"))
    assert repair_dead_letters(spark, root, "orders").count() == 0 and read_dead_letters(spark, root).count() == 3
    from pyspark.sql import functions as F

    fixed = repair_dead_letters(spark, root, "orders", lambda text: F.replace(text, F.lit('"soon"'), F.lit(str(T0))))
    assert [(r.order_id, r.order_time, r.line_item_id) for r in fixed.collect()] == [("O2", T0, "L1")]
    assert sorted((r.feed, r.raw_record) for r in read_dead_letters(spark, root).collect()) == [("orders", cut), ("traffic", "not json")]


def test_fail_mode_names_malformed_records(spark, tmp_path):
    src = tmp_path / "batch=1"
    src.mkdir()
    (src / "a.json").write_text("[1, 2")
    with pytest.raises(InvalidRecordError, match="malformed"):
        ingest_traffic(read_traffic(spark, str(tmp_path)), on_invalid="fail")


def test_tables_of_a_stored_batch_are_written_once(spark, batches, tmp_path, monkeypatch):
    names = []
    real = warehouse.materialize
    monkeypatch.setattr(warehouse, "materialize", lambda df, name="table": names.append(name) or real(df, name))
    root = str(tmp_path / "wh")
    twice = batches[0].unionByName(batches[0])
    w = run_batch(spark, empty_warehouse(spark), twice, None, root=root)
    assert waiting(w) == waiting(load_warehouse(spark, root)) == [("L1", "Ann", "no customer version", 1)]
    assert facts(w) == [("L2", 2)] and w.dim_customer.count() == 2 and w.dim_sku.count() == 1
    assert not {"dim_customer", "dim_sku", "quarantine_sales"} & set(names) and "fct_sales_batch" in names
