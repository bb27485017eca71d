import datetime as dt
import decimal

from pyspark.sql import functions as F

from starload.plans.facts import build_fct_sales
from starload.plans.summary import build_periodic_summary, build_periodic_summary_parity, touched_dates
from starload.plans.warehouse import empty_warehouse, load_sales_dims, run_batch
from starload.schemas import STG_ORDERS, STG_TRAFFIC

T0 = 1704067200


def order(line, sku="SKU-1", cust="C1", name="Ann", place="P", price="10.00", qty=1, t=T0):
    return (line, "O" + line, sku, "PR", "prod", "M", "red", price, "6.00", qty, cust, name, "ID", place, "1.00000",
            "2.00000", t, t)


def orders_df(spark, recs):
    cols = STG_ORDERS.names
    df = spark.createDataFrame(recs, ", ".join(f"{c} string" if c in ("price", "cogs", "latitude", "longitude")
                                               else f"{c} {STG_ORDERS[c].dataType.simpleString()}" for c in cols))
    return df.select(*[F.col(c).cast(STG_ORDERS[c].dataType) for c in cols])


def traffic_df(spark, recs):
    return spark.createDataFrame(recs, STG_TRAFFIC)


def test_unresolved_key_is_quarantined(spark):
    w = load_sales_dims(empty_warehouse(spark), orders_df(spark, [order("1")]))
    good, bad = build_fct_sales(orders_df(spark, [order("1"), order("2", sku="SKU-unknown")]),
                                w.dim_location, w.dim_customer, w.dim_sku)
    assert [r.line_item_id for r in good.collect()] == ["1"]
    assert [r.line_item_id for r in bad.collect()] == ["2"]


def test_null_place_resolves(spark):
    src = orders_df(spark, [order("1", place=None)])
    w = load_sales_dims(empty_warehouse(spark), src)
    good, bad = build_fct_sales(src, w.dim_location, w.dim_customer, w.dim_sku)
    assert good.count() == 1 and bad.count() == 0


def test_asof_finds_old_version(spark):
    w = load_sales_dims(empty_warehouse(spark), orders_df(spark, [order("1", price="10.00", t=T0)]))
    w = load_sales_dims(w, orders_df(spark, [order("2", price="12.00", t=T0 + 1000)]))
    late = orders_df(spark, [order("3", price="10.00", t=T0 + 10)])
    good, bad = build_fct_sales(late, w.dim_location, w.dim_customer, w.dim_sku, mode="asof")
    sku_v1 = w.dim_sku.where("price = 10.00").first().sku_id
    assert good.first().sku_id == sku_v1 and bad.count() == 0
    _, bad_active = build_fct_sales(late, w.dim_location, w.dim_customer, w.dim_sku, mode="active")
    assert bad_active.count() == 1


def test_run_batch_replay_keeps_created_at(spark):
    w = run_batch(spark, empty_warehouse(spark), orders_df(spark, [order("1", qty=1)]), None)
    w = run_batch(spark, w, orders_df(spark, [order("1", qty=4, t=T0 + 60)]), None)
    r = w.fct_sales.collect()
    assert len(r) == 1 and r[0].quantity == 4
    assert r[0].created_at == dt.datetime(2024, 1, 1) and r[0].updated_at == dt.datetime(2024, 1, 1, 0, 1)


def test_day_without_sessions(spark):
    o = orders_df(spark, [order("1"), order("2", t=T0 + 86400)])
    tr = traffic_df(spark, [("s1", T0 + 5, 3, None, 1, "Paid", "-", "Mobile", "iOS", "Edge", 0)])
    w = run_batch(spark, empty_warehouse(spark), o, tr)
    s = {r.date_id: r for r in w.fct_periodic_summary.collect()}
    assert s[20240101].num_sessions == 1 and s[20240101].page_views == 3
    assert s[20240102].num_sessions == 0 and s[20240102].page_views is None and s[20240102].clicks is None


def test_parity_equals_literal_fanout(spark):
    o = orders_df(spark, [order(str(i), qty=i, t=T0 + i * 3000, cust=f"C{i % 3}") for i in range(1, 40)])
    tr = traffic_df(spark, [(f"s{i}", T0 + i * 5000, i, None, i % 2, "Paid", "-", "Mobile", "iOS", "Edge", 1)
                            for i in range(1, 12)])
    w = run_batch(spark, empty_warehouse(spark), o, tr)
    got = {r.date_id: r.asDict() for r in
           build_periodic_summary_parity(w.fct_sales, tr, touched_dates(o, "order_time")).collect()}
    w.fct_sales.createOrReplaceTempView("fs")
    tr.createOrReplaceTempView("st")
    lit = spark.sql("""select cast(date_format(fs.order_time, 'yyyyMMdd') as int) date_id,
        count(distinct fs.order_id) unique_orders, count(distinct fs.customer_id) unique_customers,
        sum(fs.quantity) quantity, round(sum(fs.revenue)) revenue, sum(st.page_views) page_views,
        count(distinct st.session_id) num_sessions, sum(st.clicks) clicks
        from fs left join st on to_date(fs.order_time) = to_date(timestamp_seconds(st.visit_time))
        group by 1""").collect()
    assert len(lit) == len(got)
    for r in lit:
        g = got[r.date_id]
        for c in ("unique_orders", "unique_customers", "quantity", "revenue", "page_views", "num_sessions", "clicks"):
            assert (g[c] or 0) == (int(r[c]) if r[c] is not None else 0), (r.date_id, c)


def test_touched_dates_and_either(spark):
    o = orders_df(spark, [order("1")])
    tr = traffic_df(spark, [("s1", T0 + 86400 * 3, 3, None, 1, "Paid", "-", "Mobile", "iOS", "Edge", 0)])
    w = run_batch(spark, empty_warehouse(spark), o, tr)
    dates = touched_dates(o, "order_time").unionByName(spark.createDataFrame([(20240104,)], "date_id int"))
    s = build_periodic_summary(w.fct_sales, w.fct_traffic, dates, w.dim_customer, include="either")
    assert sorted(r.date_id for r in s.collect()) == [20240101, 20240104]


def test_summary_by_deltas_equals_a_rebuild(spark, tmp_path):
    """Lines are replaced, moved to another day and back, and the last one of an order and a day goes."""
    from starload.plans.tables import load_warehouse

    day = 86400
    visits = lambda *xs: traffic_df(spark, [(s, t, 2, decimal.Decimal("1.50"), 1, "t", "-", "d", "o", "b", 0) for s, t in xs])
    batches = [
        ([order("1"), order("2", cust="C2"), order("3", t=T0 + day)], visits(("a", T0), ("b", T0 + 5 * day))),
        ([order("1", qty=5, t=T0 + 2 * day), order("4", cust="C2", t=T0 + day)], None),  # line 1 leaves its day
        ([order("3", t=T0 + 2 * day)], visits(("a", T0 + 2 * day))),  # a session moves too
        ([order("1", t=T0), order("5", name="Bea", t=T0 + 9)], visits(("c", T0 + 2 * day))),  # line 1 comes back, its customer has a new version
        ([order("4", t=T0 + 6 * day), order("2", cust="C2", t=T0 + 6 * day)], None),
    ]
    root = str(tmp_path / "wh")
    for k, (lines, seen) in enumerate(batches):
        for _ in range(1 + (k == 1)):  # one batch is loaded twice
            w = run_batch(spark, load_warehouse(spark, root), orders_df(spark, lines), seen, root=root, summary="delta")
        rebuilt = build_periodic_summary(w.fct_sales, w.fct_traffic, [int(f"2024010{d}") for d in range(1, 10)], w.dim_customer)
        assert sorted(map(tuple, load_warehouse(spark, root).fct_periodic_summary.collect())) == sorted(map(tuple, rebuilt.collect()))
    assert w.summary_values.where("n <= 0").count() == 0
