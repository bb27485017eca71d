"""Batch-level properties: reloading a batch changes nothing; disjoint batches give the same
facts in either order (compared through business keys, since surrogate keys depend on arrival order)."""

from pyspark.sql import functions as F

from starload.plans.warehouse import empty_warehouse, run_batch

from test_facts_summary import T0, order, orders_df


def facts_by_business_key(w):
    c = w.dim_customer.select(F.col("customer_id"), "customer_bk")
    k = w.dim_sku.select(F.col("sku_id"), "sku_bk", "price")
    f = w.fct_sales.join(c, "customer_id").join(k, "sku_id")
    return sorted(tuple(r) for r in f.select("line_item_id", "customer_bk", "sku_bk", "price", "quantity",
                                             "revenue", "order_date_id").collect())


def test_reloading_a_batch_is_a_no_op(spark):
    b = orders_df(spark, [order("1"), order("2", sku="SKU-2", price="3.50", t=T0 + 86400, cust="C2", name="Bo")])
    w1 = run_batch(spark, empty_warehouse(spark), b, None)
    w2 = run_batch(spark, w1, b, None)
    for name in ("dim_location", "dim_customer", "dim_sku", "fct_sales", "fct_periodic_summary"):
        assert sorted(getattr(w1, name).collect()) == sorted(getattr(w2, name).collect()), name


def test_disjoint_batches_commute_for_facts(spark):
    a = orders_df(spark, [order("1", cust="C1"), order("2", cust="C2", name="Bo", sku="SKU-2", t=T0 + 60)])
    b = orders_df(spark, [order("3", cust="C3", name="Cy", sku="SKU-3", t=T0 + 86400)])
    ab = run_batch(spark, run_batch(spark, empty_warehouse(spark), a, None), b, None)
    ba = run_batch(spark, run_batch(spark, empty_warehouse(spark), b, None), a, None)
    assert facts_by_business_key(ab) == facts_by_business_key(ba)
    assert sorted(ab.fct_periodic_summary.collect()) == sorted(ba.fct_periodic_summary.collect())


def test_every_fact_key_resolves_and_one_active_version(spark):
    b1 = orders_df(spark, [order("1", name="Ann"), order("2", name="Ann", t=T0 + 10)])
    b2 = orders_df(spark, [order("3", name="Ann B", t=T0 + 100)])
    w = run_batch(spark, run_batch(spark, empty_warehouse(spark), b1, None), b2, None)
    assert w.fct_sales.join(w.dim_customer, "customer_id", "left_anti").count() == 0
    act = w.dim_customer.groupBy("customer_bk").agg(
        F.sum(F.when(F.col("current_row_indicator") == "Active", 1).otherwise(0)).alias("n"))
    assert [r.n for r in act.collect()] == [1]
