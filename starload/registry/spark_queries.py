"""Registered queries: each takes (spark, sf_dir), reads the driver's test tables through the bindings and
runs one library operator (or a whole batch) over all of their rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.dates import calendar_attributes
from starload.functions.ids import time_ordered_id
from starload.operators.dims import scd2_changes, scd2_expire, scd2_order_cols
from starload.operators.keys import assign_surrogate_keys
from starload.operators.nested import explode_items, nest_orders
from starload.operators.quality import check_accepted_values, check_foreign_key, check_not_null, check_unique
from starload.operators.sampling import random_sample, sample_per_group, sample_table
from starload.operators.windowing import assign_windows, batch_window, diagonal_union
from starload.plans.calendar import apply_holidays, build_dim_date, date_bounds
from starload.plans.catalog import build_sku_catalog
from starload.plans.constraints import check_warehouse
from starload.plans.facts import SKU_ATTRS, build_fct_sales, resolve_sales, unresolved_sales
from starload.plans.summary import build_periodic_summary_parity, touched_dates
from starload.plans.tables import load_warehouse
from starload.plans.warehouse import (
    empty_warehouse,
    load_channel,
    load_customer,
    load_device,
    load_location,
    load_sales_dims,
    load_sku,
    revenue_by_day_and_country,
    run_batch,
)
from starload.session import materialize, prepare, scratch_path
from starload.sources import bindings as B
from starload.sources.landing import (
    ingest_orders,
    ingest_traffic,
    land,
    read_holidays,
    read_orders,
    read_traffic,
    validate_orders,
)
from starload.schemas import DIM_CUSTOMER, DIM_SKU, MONEY, STG_ORDERS, STG_TRAFFIC, empty_frame
from starload.streaming.ingest import stream_dead_letters, stream_ingest_orders_to_table, stream_ingest_to_table


def _s(spark: SparkSession) -> SparkSession:
    return prepare(spark)


# ------------------------------------------------------------------------------------------ flagship

def daily_revenue_by_country(spark, d):
    """Load all orders as one batch (dims, keys, fact) and report revenue per day and country."""
    spark = _s(spark)
    w = run_batch(spark, empty_warehouse(spark), B.stg_orders(spark, d, parts_last=True), None, summary=False)
    return revenue_by_day_and_country(w)


# ------------------------------------------------------------------------------------- ingest & nesting

def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _raw_orders(stg: DataFrame) -> DataFrame:
    """Staged lines -> nested orders with every scalar as text (the shape the landing zone holds)."""
    return nest_orders(_as_text(stg))


def _land_orders(spark, stg: DataFrame) -> str:
    path = scratch_path(spark, "landing-orders")
    nested = _raw_orders(stg).withColumn("batch", F.date_format(
        F.window(F.timestamp_seconds(F.col("order_time").cast("bigint")), "4 hours").start, "yyyyMMddHHmm"))
    land(nested, path, sort_by="order_time")
    return path


def ingest_orders_q(spark, d):
    """Nest, land as JSON Lines, read back with a fixed schema, validate, flatten."""
    spark = _s(spark)
    valid, _ = ingest_orders(read_orders(spark, _land_orders(spark, B.stg_orders(spark, d))))
    return valid.select(*STG_ORDERS.names)


def landing_roundtrip(spark, d):
    """Land orders partitioned by 4-hour batch key, list ``*.json`` only, read and flatten, keep the key."""
    spark = _s(spark)
    valid, _ = ingest_orders(read_orders(spark, _land_orders(spark, B.stg_orders(spark, d))))
    return valid.select(*STG_ORDERS.names, "batch")


def ingest_traffic_q(spark, d):
    spark = _s(spark)
    path = scratch_path(spark, "landing-traffic")
    land(_as_text(assign_windows(B.stg_traffic(spark, d), "visit_time").drop("window_start", "window_end")), path,
         sort_by="visit_time")
    valid, _ = ingest_traffic(read_traffic(spark, path))
    return valid.select(*STG_TRAFFIC.names)


def explode_items_q(spark, d):
    spark = _s(spark)
    return explode_items(nest_orders(B.stg_orders(spark, d))).select(*STG_ORDERS.names)


def nest_orders_q(spark, d):
    spark = _s(spark)
    n = nest_orders(B.stg_orders(spark, d))
    return n.select(
        "order_id", "customer_id", "order_time", "updated_at",
        F.size("item_list").cast("bigint").alias("n_items"),
        F.aggregate("item_list", F.lit(0).cast("bigint"), lambda acc, i: acc + i["quantity"]).alias("quantity"),
        F.array_join(F.transform("item_list", lambda i: i["line_item_id"]), ",").alias("line_item_ids"),
    )


def validate_orders_q(spark, d):
    """Corrupt some orders (missing customer, fractional epoch, non-numeric price in the first item), land,
    read back and validate every order; one row per order with the reasons found."""
    spark = _s(spark)
    raw = _raw_orders(B.stg_orders(spark, d))
    k = F.col("order_id").cast("bigint")
    bad_item = F.transform("item_list", lambda i, pos: F.when(pos == 0, i.withField("price", F.lit("n/a")))
                           .otherwise(i))
    raw = raw.withColumns({
        "customer_id": F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("customer_id")),
        "order_time": F.when(k % 83 == 0, F.lit("12.5")).otherwise(F.col("order_time")),
        "item_list": F.when(k % 89 == 0, bad_item).otherwise(F.col("item_list")),
    }).withColumn("batch", F.lit("000000000000"))
    path = scratch_path(spark, "landing-invalid")
    land(raw, path)
    v = validate_orders(read_orders(spark, path))
    return v.select("order_id", F.col("__ok").alias("is_valid"), "reason")


def diagonal_union_q(spark, d):
    """Batch 1 with every field and batch 2 without the optional customer/location fields, by name."""
    spark = _s(spark)
    i = B.Inputs(spark, d)
    b2 = i.orders_b2.drop("name", "latitude", "longitude", "place", "country")
    return diagonal_union(i.orders_b1, b2)


def batch_window_q(spark, d):
    """Assign every session to its 4-hour extract window and count per window."""
    spark = _s(spark)
    w = assign_windows(B.stg_traffic(spark, d), "visit_time", "4 hours")
    return w.groupBy("batch", "window_start").agg(F.count(F.lit(1)).alias("sessions"),
                                                  F.sum("page_views").cast("bigint").alias("page_views"))


def time_ordered_id_q(spark, d):
    spark = _s(spark)
    s = B.stg_orders(spark, d)
    return s.select("line_item_id", time_ordered_id(F.col("order_time") * 1000, F.col("line_item_id")).alias("tid"))


# ------------------------------------------------------------------------------------------- calendar

def dim_date_q(spark, d):
    """Calendar covering every order date in the data, plus the two sentinel rows."""
    spark = _s(spark)
    lo, hi = date_bounds(B.table(spark, d, "orders"), "o_orderdate")
    return build_dim_date(spark, lo, hi)


def date_functions_q(spark, d):
    spark = _s(spark)
    e = B.table(spark, d, "events").select("event_id", F.to_date("ts").alias("__d"))
    return e.select("event_id", *[c.alias(n) for n, c in calendar_attributes(F.col("__d")).items()])


def dim_date_holidays_q(spark, d):
    """Calendar over the event days, updated from holiday records landed as JSON (one record per event:
    the event's day, its type as name, purchases as national holidays)."""
    spark = _s(spark)
    ev = B.table(spark, d, "events")
    lo, hi = date_bounds(ev, "ts")
    cal = build_dim_date(spark, lo, hi)
    path = scratch_path(spark, "landing-holidays")
    ev.select(F.date_format("ts", "yyyy-MM-dd").alias("event_date"), F.col("event_type").alias("event_name"),
              (F.col("event_type") == "purchase").alias("is_national_holiday")).write.json(path)
    return apply_holidays(cal, read_holidays(spark, path))


# ------------------------------------------------------------------------------------------ dimensions

def dim_location_q(spark, d):
    spark = _s(spark)
    w, i = empty_warehouse(spark), B.Inputs(spark, d)
    return load_location(load_location(w.dim_location, i.orders_b1), i.orders_b2)


def dim_device_q(spark, d):
    spark = _s(spark)
    w, i = empty_warehouse(spark), B.Inputs(spark, d)
    return load_device(load_device(w.dim_device, i.traffic_b1), i.traffic_b2)


def dim_channel_q(spark, d):
    spark = _s(spark)
    w, i = empty_warehouse(spark), B.Inputs(spark, d)
    return load_channel(load_channel(w.dim_channel, i.traffic_b1), i.traffic_b2)


def surrogate_keys_q(spark, d):
    spark = _s(spark)
    return assign_surrogate_keys(B.stg_orders(spark, d).select("line_item_id"), ["line_item_id"], "sk")


def _v1(i: B.Inputs, kind):
    e = empty_frame(i.spark, DIM_CUSTOMER if kind == "customer" else DIM_SKU)
    f = load_customer if kind == "customer" else load_sku
    return materialize(f(e, i.orders_b1), "dim")


def _changes(spark, d, kind):
    i = B.Inputs(spark, d)
    v1 = _v1(i, kind)
    b2 = i.orders_b2
    if kind == "customer":
        return v1, scd2_changes(v1, b2, "customer_bk", ["customer_name"], "updated_at", src_bk="customer_id",
                                src_attrs=["name"])
    return v1, scd2_changes(v1, b2, "sku_bk", SKU_ATTRS, "updated_at", src_bk="sku_id")


def scd2_changes_customer(spark, d):
    spark = _s(spark)
    return _changes(spark, d, "customer")[1]


def scd2_changes_sku(spark, d):
    spark = _s(spark)
    return _changes(spark, d, "sku")[1]


def _expire(spark, d, kind):
    """Append batch 2's new versions with keys, then expire superseded versions of the touched keys; return
    the touched keys' versions."""
    v1, ch = _changes(spark, d, kind)
    bk, sk, attrs = (("customer_bk", "customer_id", ["customer_name"]) if kind == "customer"
                     else ("sku_bk", "sku_id", SKU_ATTRS))
    ch = assign_surrogate_keys(ch, scd2_order_cols(bk, attrs), sk, start=v1.agg(F.max(sk)))
    allv = v1.unionByName(ch.select(*v1.columns))
    out = scd2_expire(allv, ch.select(bk), bk, sk)
    return out.join(ch.select(bk).distinct(), bk, "left_semi")


def scd2_expire_q(spark, d):
    spark = _s(spark)
    return _expire(spark, d, "customer")


def scd2_expire_sku(spark, d):
    spark = _s(spark)
    return _expire(spark, d, "sku")


def scd2_customer(spark, d):
    spark = _s(spark)
    i = B.Inputs(spark, d)
    return load_customer(_v1(i, "customer"), i.orders_b2)


def scd2_sku(spark, d):
    spark = _s(spark)
    i = B.Inputs(spark, d)
    return load_sku(_v1(i, "sku"), i.orders_b2)


def _wavering(spark, d):
    """All lines; every customer's name changes to and fro each five days."""
    period = F.floor((F.col("order_time") - B.EPOCH_BASE) / (5 * B.DAY)) % 2
    return materialize(B.stg_orders(spark, d, parts_last=True).withColumn("name", F.concat("name", F.when(period == 1, " v2").otherwise(""))), "stage")


def scd2_runs_customer(spark, d):
    """All lines as one batch in which names change to and fro: a version for each run."""
    spark = _s(spark)
    return load_customer(empty_frame(spark, DIM_CUSTOMER), _wavering(spark, d))


def quarantine_retry(spark, d):
    """All lines in three stored batches of ten days, in each of which names change.  Lines under a name that isn't current wait in
    the stored quarantine, and resolve with a later batch that brings the name back.  One row for each line."""
    spark = _s(spark)
    root, lines = scratch_path(spark, "warehouse"), _wavering(spark, d)
    for k in range(3):
        batch = lines.where(F.floor((F.col("order_time") - B.EPOCH_BASE) / (10 * B.DAY)) == k)
        run_batch(spark, load_warehouse(spark, root), batch, None, staged=True, root=root, summary=False)
    w = load_warehouse(spark, root)
    loaded = w.fct_sales.select("line_item_id", "customer_id", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("int").alias("attempts"))
    return loaded.unionByName(w.quarantine_sales.select("line_item_id", F.lit(None).cast("long").alias("customer_id"), "reason", "attempts"))


def scd2_replay_sku(spark, d):
    """Two batches, both once more, and twice a late batch of other prices within their time."""
    spark = _s(spark)
    i = B.Inputs(spark, d)
    some = i.orders.where(F.floor((F.col("order_time") - B.EPOCH_BASE) / B.DAY) % 10 == 3)
    late = some.withColumns({"price": (F.col("price") * F.lit(1.25).cast("decimal(3,2)")).cast(MONEY), "updated_at": F.col("updated_at") + B.DAY // 2})
    dim = empty_frame(spark, DIM_SKU)
    for orders in (i.orders_b1, i.orders_b2, i.orders_b1, i.orders_b2, late, late):
        dim = materialize(load_sku(dim, orders), "dim")
    return dim


def scd2_parity_all_versions(spark, d):
    """Three batches (1, 2, 2 again) with the original rules: compare with all versions, effective from the
    latest sighting, close only open versions."""
    spark = _s(spark)
    kw = dict(compare="all", eff="max", recompute=False)
    i = B.Inputs(spark, d)
    c = empty_frame(spark, DIM_CUSTOMER)
    c = materialize(load_customer(c, i.orders_b1, **kw), "dim")
    c = materialize(load_customer(c, i.orders_b2, **kw), "dim")
    return load_customer(c, i.orders_b2, **kw)


# ------------------------------------------------------------------------------------------------ facts

def _w1(i: B.Inputs):
    """Batch 1 of the orders into an empty warehouse."""
    return run_batch(i.spark, empty_warehouse(i.spark), i.orders_b1, None, staged=True, summary=False)


def _w2(i: B.Inputs, orders: bool = True, traffic: bool = True, summary: bool = True):
    """Both batches into a stored warehouse, which the second one reads as the first one published it."""
    root = scratch_path(i.spark, "warehouse")
    for o, t in ((i.orders_b1, i.traffic_b1), (i.orders_b2, i.traffic_b2)):
        w = run_batch(i.spark, load_warehouse(i.spark, root), o if orders else None, t if traffic else None, staged=True, root=root, summary=summary)
    return w


def fct_sales_q(spark, d):
    """All lines as one batch, resolved against the dimensions that it makes."""
    spark = _s(spark)
    return run_batch(spark, empty_warehouse(spark), B.stg_orders(spark, d, parts_last=True), None, summary=False).fct_sales


def fct_traffic_q(spark, d):
    """All sessions as one batch."""
    spark = _s(spark)
    return run_batch(spark, empty_warehouse(spark), None, B.stg_traffic(spark, d), summary=False).fct_traffic


def unresolved_keys(spark, d):
    """Batch 2 resolved against batch 1's current versions: changed customers and prices are quarantined."""
    spark = _s(spark)
    i = B.Inputs(spark, d)
    w = _dims(i, i.orders_b1)
    return unresolved_sales(i.orders_b2, w.dim_location, w.dim_customer, w.dim_sku)


def _dims(i: B.Inputs, *batches):
    """The dimensions of sales after some batches, each kept before the next one reads it."""
    w = empty_warehouse(i.spark)
    for orders in batches:
        w = load_sales_dims(w, orders)
        w = replace(w, dim_customer=materialize(w.dim_customer, "dim_customer"), dim_sku=materialize(w.dim_sku, "dim_sku"))
    return w


def fct_sales_asof(spark, d):
    """All lines of both batches, each with the versions that were valid at its order time."""
    spark = _s(spark)
    i = B.Inputs(spark, d)
    w = _dims(i, i.orders_b1, i.orders_b2)
    good, _ = build_fct_sales(i.orders_b1.unionByName(i.orders_b2), w.dim_location, w.dim_customer, w.dim_sku, mode="asof")
    return good


def merge_sales(spark, d):
    spark = _s(spark)
    return _w2(B.Inputs(spark, d), traffic=False, summary=False).fct_sales


def merge_traffic(spark, d):
    spark = _s(spark)
    return _w2(B.Inputs(spark, d), orders=False, summary=False).fct_traffic


def merge_summary(spark, d):
    spark = _s(spark)
    return _w2(B.Inputs(spark, d)).fct_periodic_summary


def check_foreign_key_q(spark, d):
    """Batch-1 sales lines whose customer version is no longer current after batch 2."""
    spark = _s(spark)
    i = B.Inputs(spark, d)
    w1 = _w1(i)
    active = load_customer(w1.dim_customer, i.orders_b2).where(F.col("current_row_indicator") == "Active")
    return check_foreign_key(w1.fct_sales, active, ["customer_id"])


def check_not_null_q(spark, d):
    """The NOT NULL rule of the fact's key columns, checked on batch 2 resolved against batch 1's current
    versions (before the split into fact and quarantine)."""
    spark = _s(spark)
    i = B.Inputs(spark, d)
    w = _dims(i, i.orders_b1)
    r = resolve_sales(i.orders_b2, w.dim_location, w.dim_customer, w.dim_sku)
    return check_not_null(r, ["sku_id", "customer_id", "location_id"]).select(
        "line_item_id", "sku_id", "customer_id", "location_id")


def _faulty(spark, d) -> dict:
    """The tables of a warehouse with all rows loaded as one batch, then broken: repeated lines and sessions, nulls, versions and
    days taken away, natural keys given twice, a day summed twice."""
    w = run_batch(spark, empty_warehouse(spark), B.stg_orders(spark, d, parts_last=True), B.stg_traffic(spark, d))
    order_no, session = F.col("order_id").cast("bigint"), F.col("session_id").cast("bigint")
    sales = w.fct_sales.withColumn("customer_id", F.when(order_no % 103 != 0, F.col("customer_id")))
    traffic = w.fct_traffic.withColumn("device_id", F.when(session % 107 != 0, F.col("device_id")))
    device = w.dim_device.withColumn("os", F.when(F.col("device_id") > 2, F.col("os"))).withColumn("browser", F.when(F.col("device_id") > 2, F.col("browser")))
    return {
        "dim_date": build_dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 21)),
        "dim_location": w.dim_location.unionByName(w.dim_location.where("location_id = 3").withColumn("location_id", F.lit(-3).cast("bigint"))),
        "dim_customer": w.dim_customer.withColumn("customer_id", F.when(F.col("customer_id") % 211 != 0, F.col("customer_id"))),
        "dim_sku": w.dim_sku.where("sku_id % 97 <> 0"),
        "dim_device": device.withColumn("device_name", F.when(F.col("device_id") > 2, F.col("device_name"))),
        "dim_channel": w.dim_channel.unionByName(w.dim_channel.where("channel_id = 1")),
        "fct_sales": sales.unionByName(sales.where(order_no % 101 == 0)),
        "fct_traffic": traffic.unionByName(traffic.where(session % 109 == 0)),
        "fct_periodic_summary": w.fct_periodic_summary.unionByName(w.fct_periodic_summary.where("date_id % 10 = 4")),
    }


def check_warehouse_q(spark, d):
    """All constraints of the warehouse on tables with faults."""
    spark = _s(spark)
    # facts are read once, as they lie in the warehouse; dimensions are parents too
    return check_warehouse({name: df if name.startswith("fct_") else materialize(df, name) for name, df in _faulty(spark, d).items()})


def check_accepted_values_q(spark, d):
    """Sessions from a traffic source that isn't one of the two that are paid for or searched."""
    spark = _s(spark)
    return check_accepted_values(B.stg_traffic(spark, d), "traffic_source", ["Organic", "Paid"]).select("session_id", "traffic_source")


def batch_window_rows_q(spark, d):
    """All sessions, cut into consecutive half-open extract windows of five days."""
    spark = _s(spark)
    visits, (lo, hi) = B.stg_traffic(spark, d), date_bounds(B.table(spark, d, "events"), "ts")
    length = dt.timedelta(days=5)
    starts = [dt.datetime.combine(lo, dt.time()) + k * length for k in range(-(-(hi - lo).days // 5))]
    windows = [batch_window(visits, "visit_time", at, length).withColumn("window_no", F.lit(k)) for k, at in enumerate(starts)]
    return reduce(lambda a, b: a.unionByName(b), windows).select("session_id", "visit_time", "window_no")


def touched_dates_q(spark, d):
    """The days of the lines of both batches."""
    spark = _s(spark)
    return touched_dates(B.stg_orders(spark, d), "order_time")


def summary_deltas(spark, d):
    """All lines and sessions in five stored batches of six days; each but the first also brings the lines of every third order of the
    batch before once more, a day later and with another quantity.  The summary is changed by deltas only."""
    spark = _s(spark)
    i, root = B.Inputs(spark, d), scratch_path(spark, "warehouse")
    orders, visits = (df.withColumn("k", F.floor((F.col(t) - B.EPOCH_BASE) / (6 * B.DAY))) for df, t in ((i.orders, "order_time"), (i.traffic, "visit_time")))
    again = orders.where(F.col("order_id").cast("bigint") % 3 == 0).withColumns({
        "k": F.col("k") + 1, "quantity": (F.col("quantity") + 1).cast("int"), "order_time": F.col("order_time") + B.DAY, "updated_at": F.col("updated_at") + B.DAY})
    lines = orders.unionByName(again)
    for k in range(5):
        run_batch(spark, load_warehouse(spark, root), lines.where(F.col("k") == k).drop("k"), visits.where(F.col("k") == k).drop("k"), staged=True, root=root, summary="delta")
    return load_warehouse(spark, root).fct_periodic_summary


def periodic_summary(spark, d):
    spark = _s(spark)
    w = run_batch(spark, empty_warehouse(spark), B.stg_orders(spark, d, parts_last=True), B.stg_traffic(spark, d))
    return w.fct_periodic_summary


def periodic_summary_parity(spark, d):
    spark = _s(spark)
    i = B.Inputs(spark, d)
    w = run_batch(spark, empty_warehouse(spark), i.orders, i.traffic, staged=True, summary=False)
    return build_periodic_summary_parity(w.fct_sales, i.traffic, touched_dates(i.orders, "order_time"))


# ------------------------------------------------------------------------------------- catalogue, sampling

def sku_catalog(spark, d):
    """Products are the part brands (base price = the brand's lowest retail price)."""
    spark = _s(spark)
    p = B.table(spark, d, "part").groupBy(F.col("p_brand").alias("product_name")).agg(
        F.min("p_retailprice").cast("decimal(12,2)").alias("base_price"))
    return build_sku_catalog(p)


def random_sample_q(spark, d):
    spark = _s(spark)
    c = B.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return random_sample(c, 100, "c_custkey", 42)


def sample_table_q(spark, d):
    """The same sample through a parameterised SQL scan of a registered view."""
    spark = _s(spark)
    B.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey").createOrReplaceTempView(
        "starload_customer_sample_src")
    return sample_table(spark, "starload_customer_sample_src", 100, "c_custkey", 42)


def sample_per_group_q(spark, d):
    """For every order, as many distinct parts as it has lines, drawn with seed 7."""
    spark = _s(spark)
    groups = B.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("k"))
    items = B.table(spark, d, "part").select("p_partkey", "p_name")
    return sample_per_group(groups, items, "o_orderkey", "k", "p_partkey", 7)


def check_unique_q(spark, d):
    spark = _s(spark)
    return check_unique(B.stg_orders(spark, d), ["order_id", "sku_id"])


# -------------------------------------------------------------------------------------------- streaming

def stream_ingest_q(spark, d):
    """Land traffic per 4-hour batch, consume it with an available-now file stream that archives consumed
    files, and merge each micro-batch into the traffic fact by session id."""
    spark = _s(spark)
    src = scratch_path(spark, "stream-src")
    land(_as_text(assign_windows(B.stg_traffic(spark, d), "visit_time").drop("window_start", "window_end")), src,
         sort_by="visit_time")
    return stream_ingest_to_table(spark, src)


def stream_ingest_orders_q(spark, d):
    """Land nested orders per 4-hour batch, consume them with an available-now file stream, validate and
    flatten each micro-batch and merge it into the staged lines by line id."""
    spark = _s(spark)
    return stream_ingest_orders_to_table(spark, _land_orders(spark, B.stg_orders(spark, d)))


def stream_triggers(spark, d):
    """Three triggers of one stream: the sessions of batch 1, those of batch 2, of which some have page views that are no number, and
    batch 2 once more in other files.  One row for each session in the table and for each dead letter."""
    spark = _s(spark)
    i, table, src = B.Inputs(spark, d), scratch_path(spark, "stream-table"), scratch_path(spark, "stream-src")
    odd = F.col("session_id").cast("bigint") % 97 == 0
    second = i.traffic_b2.withColumn("page_views", F.when(odd, "many").otherwise(F.col("page_views").cast("string")))
    for batch in (i.traffic_b1, second, second):
        land(_as_text(assign_windows(batch, "visit_time").drop("window_start", "window_end")), src, sort_by="visit_time")
        rows = stream_ingest_to_table(spark, src, table)
    letters = stream_dead_letters(spark, table).groupBy(F.col("record_key").alias("session_id"), "reason").agg(F.countDistinct("raw_record").alias("n"))
    loaded = rows.select("session_id", "page_views", F.lit(None).cast("string").alias("reason"), F.lit(1).cast("bigint").alias("n"))
    return loaded.unionByName(letters.withColumn("page_views", F.lit(None).cast("int")))


REGISTRY = {
    "daily_revenue_by_country": daily_revenue_by_country,
    "ingest_orders": ingest_orders_q,
    "ingest_traffic": ingest_traffic_q,
    "explode_items": explode_items_q,
    "nest_orders": nest_orders_q,
    "validate_orders": validate_orders_q,
    "landing_roundtrip": landing_roundtrip,
    "diagonal_union": diagonal_union_q,
    "batch_window": batch_window_q,
    "dim_date": dim_date_q,
    "date_functions": date_functions_q,
    "dim_date_holidays": dim_date_holidays_q,
    "dim_location": dim_location_q,
    "dim_device": dim_device_q,
    "dim_channel": dim_channel_q,
    "surrogate_keys": surrogate_keys_q,
    "scd2_changes_customer": scd2_changes_customer,
    "scd2_changes_sku": scd2_changes_sku,
    "scd2_expire": scd2_expire_q,
    "scd2_expire_sku": scd2_expire_sku,
    "scd2_customer": scd2_customer,
    "scd2_sku": scd2_sku,
    "scd2_runs_customer": scd2_runs_customer,
    "scd2_replay_sku": scd2_replay_sku,
    "quarantine_retry": quarantine_retry,
    "scd2_parity_all_versions": scd2_parity_all_versions,
    "fct_sales": fct_sales_q,
    "fct_sales_asof": fct_sales_asof,
    "fct_traffic": fct_traffic_q,
    "unresolved_keys": unresolved_keys,
    "merge_sales": merge_sales,
    "merge_traffic": merge_traffic,
    "merge_summary": merge_summary,
    "touched_dates": touched_dates_q,
    "summary_deltas": summary_deltas,
    "periodic_summary": periodic_summary,
    "periodic_summary_parity": periodic_summary_parity,
    "sku_catalog": sku_catalog,
    "random_sample": random_sample_q,
    "sample_table": sample_table_q,
    "sample_per_group": sample_per_group_q,
    "time_ordered_id": time_ordered_id_q,
    "check_unique": check_unique_q,
    "check_foreign_key": check_foreign_key_q,
    "check_not_null": check_not_null_q,
    "check_warehouse": check_warehouse_q,
    "check_accepted_values": check_accepted_values_q,
    "batch_window_rows": batch_window_rows_q,
    "stream_ingest": stream_ingest_q,
    "stream_ingest_orders": stream_ingest_orders_q,
    "stream_triggers": stream_triggers,
}
