import json

from starload.sources.landing import ingest_orders, ingest_traffic, read_orders, read_traffic


def write_lines(tmp_path, name, recs, batch="202401010000"):
    d = tmp_path / name / f"batch={batch}"
    d.mkdir(parents=True)
    (d / "part-0.json").write_text("\n".join(json.dumps(r) for r in recs))
    (d / "ignored.txt").write_text("not json")
    return str(tmp_path / name)


ITEM = {"line_item_id": "L1", "sku_id": "S", "product_id": "P", "product_name": "n", "size": "M", "color": "c",
        "price": "14.99", "cogs": 8.99, "quantity": 2}


def order(**kw):
    o = {"order_id": "O1", "customer_id": "C1", "order_time": 1704067200, "item_list": [ITEM],
         "updated_at": 1704067200}
    o.update(kw)
    return o


def test_text_number_and_empty_items(spark, tmp_path):
    p = write_lines(tmp_path, "o", [order(), order(order_id="O2", item_list=[])])
    valid, bad = ingest_orders(read_orders(spark, p))
    r = {x.order_id: x for x in valid.collect()}
    assert str(r["O1"].price) == "14.99" and r["O1"].quantity == 2 and r["O1"].batch == "202401010000"
    assert r["O2"].line_item_id is None and bad.count() == 0


def test_missing_required_is_quarantined(spark, tmp_path):
    o = order(order_id="O3")
    del o["customer_id"]
    bad_item = dict(ITEM, quantity="1.5")
    p = write_lines(tmp_path, "o", [o, order(order_id="O4", item_list=[bad_item]), order(order_id="O5")])
    valid, bad = ingest_orders(read_orders(spark, p))
    assert [x.order_id for x in valid.collect()] == ["O5"]
    reasons = {x.order_id: x.reason for x in bad.collect()}
    assert reasons == {"O3": "missing customer_id", "O4": "bad item field"}


def test_fail_mode_raises(spark, tmp_path):
    import pytest

    from starload.sources.landing import InvalidRecordError

    o = order()
    del o["order_time"]
    p = write_lines(tmp_path, "o", [o])
    with pytest.raises(InvalidRecordError):
        ingest_orders(read_orders(spark, p), on_invalid="fail")


def test_visit_defaults(spark, tmp_path):
    p = write_lines(tmp_path, "t", [{"session_id": "s", "visit_time": 1704067200, "page_views": 3,
                                     "session_duration": 1.5}])
    valid, bad = ingest_traffic(read_traffic(spark, p))
    r = valid.first()
    assert (r.clicks, r.traffic_source, r.referral_source, r.device, r.os, r.browser, r.transactions) == \
        (0, "Unknown", "-", "Unknown", "Unknown", "Unknown", 0)
    assert bad.count() == 0


def test_enveloped_document(spark, tmp_path):
    d = tmp_path / "env" / "batch=202401010400"
    d.mkdir(parents=True)
    (d / "doc.json").write_text(json.dumps({"order_count": 2, "orders": [order(), order(order_id="O9")]}))
    valid, _ = ingest_orders(read_orders(spark, str(tmp_path / "env"), envelope=True))
    assert sorted(r.order_id for r in valid.collect()) == ["O1", "O9"]


def test_missing_prefix_is_empty_batch(spark, tmp_path):
    valid, bad = ingest_orders(read_orders(spark, str(tmp_path / "nothing-landed-yet")))
    assert valid.count() == 0 and bad.count() == 0
    assert "line_item_id" in valid.columns


def test_a_line_is_parsed_once(spark, tmp_path):
    p = write_lines(tmp_path, "o", [order(), order(order_id="O2", order_time="12.5"), order(order_id="O3", item_list=[dict(ITEM, quantity=q) for q in ("3.0", " 4 ", "-5")])])
    valid, bad = ingest_orders(read_orders(spark, p))
    for df in (valid, bad):
        assert df._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    assert sorted(x.quantity for x in valid.collect()) == [-5, 2, 3, 4] and [x.reason for x in bad.collect()] == ["bad order_time"]
