import os

from starload.plans import commits, warehouse
from starload.plans.tables import STORED, create_tables, load_warehouse, publish_tables, save_warehouse, table_ddl
from starload.plans.warehouse import empty_warehouse, run_batch

from test_facts_summary import T0, order, orders_df


def test_ddl_defaults_and_partitioning():
    ddl = table_ddl("wh", "dim_date")
    assert "`is_holiday` string DEFAULT 'Non-Holiday'" in ddl and "`event_name` string DEFAULT '-'" in ddl
    assert "PARTITIONED BY (order_date_id)" in table_ddl("wh", "fct_sales")


def test_default_applies_only_to_omitted_columns(spark, tmp_path):
    create_tables(spark, "starload_t", str(tmp_path / "wh"))
    spark.sql("INSERT INTO starload_t.dim_date (date_id, date) VALUES (20240101, DATE'2024-01-01')")
    spark.sql("INSERT INTO starload_t.dim_date (date_id, event_name, is_holiday) VALUES (-1, NULL, NULL)")
    r = {x.date_id: x for x in spark.table("starload_t.dim_date").collect()}
    assert (r[20240101].event_name, r[20240101].is_holiday, r[20240101].is_weekend) == ("-", "Non-Holiday", "Weekday")
    assert r[-1].event_name is None and r[-1].is_holiday is None and r[-1].full_date_description == "Not Entered"
    spark.sql("DROP DATABASE starload_t CASCADE")


def test_save_rewrites_only_touched_partitions(spark, tmp_path):
    root = str(tmp_path / "wh")
    b1 = orders_df(spark, [order("1", t=T0), order("2", t=T0 + 86400)])
    w1 = run_batch(spark, empty_warehouse(spark), b1, None)
    save_warehouse(w1, root)
    first = commits.state(spark, root)
    assert first.parts("fct_sales") == ["20240101", "20240102"]
    day2 = sorted(os.listdir(f"{root}/fct_sales/order_date_id=20240102"))
    # line 1 moves from day 1 to day 3; day 2 is untouched and must keep its files
    prev = load_warehouse(spark, root)
    b2 = orders_df(spark, [order("1", t=T0 + 2 * 86400)])
    w2 = run_batch(spark, prev, b2, None)
    second = save_warehouse(w2, root, previous=prev)
    assert second.parts("fct_sales") == ["20240102", "20240103"]
    assert second.paths["fct_sales", "20240102"] == first.paths["fct_sales", "20240102"]
    assert sorted(os.listdir(f"{root}/fct_sales/order_date_id=20240102")) == day2
    got = {r.line_item_id: r.order_date_id for r in load_warehouse(spark, root).fct_sales.collect()}
    assert got == {"1": 20240103, "2": 20240102}


def test_run_batch_on_storage_matches_in_memory(spark, tmp_path):
    from starload.plans.tables import load_warehouse

    root = str(tmp_path / "wh2")
    b1 = orders_df(spark, [order("1", t=T0), order("2", t=T0 + 86400), order("3", t=T0 + 86400)])
    b2 = orders_df(spark, [order("1", qty=3, t=T0 + 2 * 86400), order("4", t=T0 + 3 * 86400)])
    mem = run_batch(spark, run_batch(spark, empty_warehouse(spark), b1, None), b2, None)
    run_batch(spark, empty_warehouse(spark), b1, None, root=root)
    disk = run_batch(spark, load_warehouse(spark, root), b2, None, root=root)
    key = lambda r: r.line_item_id
    assert sorted(mem.fct_sales.collect(), key=key) == sorted(disk.fct_sales.collect(), key=key)
    assert sorted(mem.fct_periodic_summary.collect()) == sorted(disk.fct_periodic_summary.collect())
    # line 1 moved from day 1 to day 3: day 1 is gone, not left with a stale copy
    assert commits.state(spark, root).parts("fct_sales") == ["20240102", "20240103", "20240104"]
    old = load_warehouse(spark, root, number=0)  # the state before stays readable until it is cleared
    assert {r.order_date_id for r in old.fct_sales.collect()} == {20240101, 20240102}
    assert commits.vacuum(spark, root, keep=1) > 0
    assert not os.path.exists(f"{root}/fct_sales/order_date_id=20240101/c=0")
    assert sorted(load_warehouse(spark, root).fct_sales.collect(), key=key) == sorted(mem.fct_sales.collect(), key=key)


def test_killed_batch_leaves_the_old_state(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh3")
    run_batch(spark, empty_warehouse(spark), orders_df(spark, [order("1", t=T0)]), None, root=root)
    before = {name: sorted(map(tuple, getattr(load_warehouse(spark, root), name).collect()), key=str) for name in STORED}
    put, calls = warehouse.put_table, []

    def dies(at, table, rows):
        calls.append(table)
        if len(calls) == 3:
            raise RuntimeError("killed")
        put(at, table, rows)

    second = orders_df(spark, [order("1", qty=9, t=T0 + 86400), order("2", cust="C2", place="Q", t=T0)])
    monkeypatch.setattr(warehouse, "put_table", dies)
    try:
        run_batch(spark, load_warehouse(spark, root), second, None, root=root)
    except RuntimeError:
        pass
    assert len(calls) == 3 and commits.commits(spark, root) == [0]
    after = {name: sorted(map(tuple, getattr(load_warehouse(spark, root), name).collect()), key=str) for name in STORED}
    assert after == before
    monkeypatch.setattr(warehouse, "put_table", put)  # the batch runs again over what the killed one left
    w = run_batch(spark, load_warehouse(spark, root), second, None, root=root)
    assert {r.line_item_id: (r.quantity, r.order_date_id) for r in w.fct_sales.collect()} == {"1": (9, 20240102), "2": (1, 20240101)}


def test_catalog_tables_show_the_last_commit(spark, tmp_path):
    root, db = str(tmp_path / "wh4"), "starload_pub"
    w = empty_warehouse(spark)
    for recs in ([order("1", t=T0), order("2", t=T0 + 86400)], [order("1", qty=3, t=T0 + 2 * 86400), order("4", t=T0 + 3 * 86400)]):
        w = run_batch(spark, w, orders_df(spark, recs), None, root=root)
        publish_tables(spark, root, db)
        for name in STORED:
            want = getattr(load_warehouse(spark, root), name)
            assert sorted(map(tuple, spark.table(f"{db}.{name}").select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str), name
    assert spark.table(f"{db}.fct_sales").count() == 3
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_summary_reads_only_the_partitions_of_its_days(spark, tmp_path):
    from starload.plans.summary import build_periodic_summary

    root = str(tmp_path / "wh5")
    w = run_batch(spark, empty_warehouse(spark), orders_df(spark, [order(str(i), t=T0 + i * 86400) for i in range(5)]), None, root=root)
    days = build_periodic_summary(w.fct_sales, w.fct_traffic, [20240102, 20240104], w.dim_customer)
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date_id" in plan or "PartitionFilters: [order_date_id" in plan
    assert "20240104" in plan.split("PartitionFilters", 1)[1].split("]", 1)[0] and days.count() == 2


def test_staging_table_replace_create_drop(spark):
    import pytest

    from starload.sources.landing import create_table_or_fail, drop_table, replace_table

    df = spark.range(3)
    replace_table(df, "starload_stg_t")
    replace_table(spark.range(5), "starload_stg_t")
    assert spark.table("starload_stg_t").count() == 5
    with pytest.raises(Exception):
        create_table_or_fail(df, "starload_stg_t")
    drop_table(spark, "starload_stg_t")
    assert not spark.catalog.tableExists("starload_stg_t")
