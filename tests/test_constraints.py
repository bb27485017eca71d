"""The constraint suite on small tables with one fault of each kind."""

import pytest

from starload.plans.constraints import PRIMARY, REFERENCES, UNIQUE, check_warehouse, warehouse_rules

SOUND = {
    "dim_date": ("date_id int", [(20240101,), (20240102,), (-1,)]),
    "dim_location": ("location_id long, country string, place string, longitude decimal(12,5), latitude decimal(12,5)", [(1, "ID", None, None, None), (2, "ID", "P", None, None)]),
    "dim_customer": ("customer_id long", [(1,), (2,)]),
    "dim_sku": ("sku_id long", [(1,)]),
    "dim_device": ("device_id long, device_name string, os string, browser string", [(1, "d", "o", "b"), (2, "d", "o", None)]),
    "dim_channel": ("channel_id long, traffic_source string, referral_source string", [(1, "t", "-")]),
    "fct_sales": ("line_item_id string, sku_id long, customer_id long, location_id long, order_date_id int", [("L1", 1, 1, 1, 20240101), ("L2", 1, 2, 2, 20240102)]),
    "fct_traffic": ("session_id string, channel_id long, device_id long, visit_date_id int", [("s", 1, 1, 20240101)]),
    "fct_periodic_summary": ("date_id int", [(20240101,)]),
}


def violations(spark, **changed):
    tables = {t: spark.createDataFrame(changed.get(t, rows), schema) for t, (schema, rows) in SOUND.items()}
    return sorted((r.table, r.rule, r.key, r.n) for r in check_warehouse(tables).collect())


def test_nine_three_and_eight():
    kinds = [r.kind for r in warehouse_rules()]
    assert (kinds.count("primary key"), kinds.count("unique"), kinds.count("foreign key")) == (9, 3, 8)
    assert (len(PRIMARY), len(UNIQUE), sum(map(len, REFERENCES.values()))) == (9, 3, 8)


def test_sound_tables(spark):
    assert violations(spark) == []


def test_faults(spark):
    assert violations(
        spark, dim_location=[(1, "ID", None, None, None), (3, "ID", None, None, None)],  # given twice, nulls are equal; 2 is gone
        dim_customer=[(1,), (1,), (None,)], fct_sales=[("L1", 1, 1, 1, 20240101), ("L1", None, 9, 2, 20240102), (None, 1, 1, 3, None)],
        fct_traffic=[("s", 7, 1, 20240203), ("t", 7, 1, 20240101)], fct_periodic_summary=[(20240105,), (20240105,)]) == [
        ("dim_customer", "not null (customer_id)", "NULL", 1),
        ("dim_customer", "primary key (customer_id)", "1", 2),
        ("dim_location", "unique (place, country, latitude, longitude)", "NULL|ID|NULL|NULL", 2),
        ("fct_periodic_summary", "foreign key (date_id) -> dim_date", "20240105", 2),
        ("fct_periodic_summary", "primary key (date_id)", "20240105", 2),
        ("fct_sales", "foreign key (customer_id) -> dim_customer", "9", 1),
        ("fct_sales", "foreign key (location_id) -> dim_location", "2", 1),
        ("fct_sales", "not null (line_item_id)", "NULL", 1),
        ("fct_sales", "not null (order_date_id)", "NULL", 1),
        ("fct_sales", "not null (sku_id)", "L1", 1),
        ("fct_sales", "primary key (line_item_id)", "L1", 2),
        ("fct_traffic", "foreign key (channel_id) -> dim_channel", "7", 2),
        ("fct_traffic", "foreign key (visit_date_id) -> dim_date", "20240203", 1),
    ]


def test_a_missing_table_is_an_error(spark):
    with pytest.raises(ValueError, match="dim_date"):
        check_warehouse({t: spark.createDataFrame(rows, schema) for t, (schema, rows) in SOUND.items() if t != "dim_date"})
