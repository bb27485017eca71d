"""The batch job: dimensions, then facts, then the daily summary, for one batch of orders and sessions.

Order follows the dependencies: location before customer, SKU independent; device and channel independent;
each fact after its dimensions; the summary last.  Every table is returned whole as a DataFrame; with
``persist=True`` each new table is written once as parquet under the shared checkpoint directory, so the next
batch does not re-run this batch's lineage (and survives executor loss).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.operators.dims import insert_ignore, scd2_apply
from starload.operators.merge import in_parts, merge_touched
from starload.plans.commits import State, commit, put_partitions, put_table, read_table, state
from starload.plans.deltas import DAY_STATE, VALUE_STATE, change_days, signed_rows, summary_of
from starload.plans.facts import (
    CHANNEL_KEYS,
    DEVICE_KEYS,
    DEVICE_SRC,
    LOCATION_KEYS,
    SALES_KEYS,
    SKU_ATTRS,
    TRAFFIC_KEYS,
    UnresolvedKeyError,
    missing_keys,
    one_per_line,
    one_per_session,
    quarantined,
    resolve_sales,
    resolve_traffic,
    split_resolved,
)
from starload.plans.summary import build_periodic_summary
from starload.schemas import (
    DIM_CHANNEL,
    DIM_CUSTOMER,
    DIM_DEVICE,
    DIM_LOCATION,
    DIM_SKU,
    FCT_PERIODIC_SUMMARY,
    FCT_SALES,
    FCT_TRAFFIC,
    QUARANTINE_SALES,
    QUARANTINE_TRAFFIC,
    STG_ORDERS,
    STG_TRAFFIC,
    empty_frame,
)
from starload.session import checkpoint_dir, materialize


@dataclass(frozen=True)
class Warehouse:
    dim_location: DataFrame
    dim_customer: DataFrame
    dim_sku: DataFrame
    dim_device: DataFrame
    dim_channel: DataFrame
    fct_sales: DataFrame
    fct_traffic: DataFrame
    fct_periodic_summary: DataFrame
    quarantine_sales: DataFrame
    quarantine_traffic: DataFrame
    summary_days: DataFrame
    summary_values: DataFrame


def empty_warehouse(spark: SparkSession) -> Warehouse:
    e = lambda s: empty_frame(spark, s)
    return Warehouse(e(DIM_LOCATION), e(DIM_CUSTOMER), e(DIM_SKU), e(DIM_DEVICE), e(DIM_CHANNEL), e(FCT_SALES),
                     e(FCT_TRAFFIC), e(FCT_PERIODIC_SUMMARY), e(QUARANTINE_SALES), e(QUARANTINE_TRAFFIC),
                     e(DAY_STATE), e(VALUE_STATE))


def load_location(dim_location: DataFrame, orders: DataFrame) -> DataFrame:
    return insert_ignore(dim_location, orders, LOCATION_KEYS, "location_id")


def load_customer(dim_customer: DataFrame, orders: DataFrame, **scd2) -> DataFrame:
    return scd2_apply(dim_customer, orders, "customer_bk", ["customer_name"], "updated_at", "customer_id",
                      src_bk="customer_id", src_attrs=["name"], **scd2)


def load_sku(dim_sku: DataFrame, orders: DataFrame, **scd2) -> DataFrame:
    return scd2_apply(dim_sku, orders, "sku_bk", SKU_ATTRS, "updated_at", "sku_id", src_bk="sku_id", **scd2)


def load_device(dim_device: DataFrame, traffic: DataFrame) -> DataFrame:
    return insert_ignore(dim_device, traffic, DEVICE_KEYS, "device_id", src_keys=DEVICE_SRC)


def load_channel(dim_channel: DataFrame, traffic: DataFrame) -> DataFrame:
    return insert_ignore(dim_channel, traffic, CHANNEL_KEYS, "channel_id")


def load_sales_dims(w: Warehouse, orders: DataFrame, **scd2) -> Warehouse:
    return replace(w, dim_location=load_location(w.dim_location, orders),
                   dim_customer=load_customer(w.dim_customer, orders, **scd2),
                   dim_sku=load_sku(w.dim_sku, orders, **scd2))


def load_traffic_dims(w: Warehouse, traffic: DataFrame) -> Warehouse:
    return replace(w, dim_device=load_device(w.dim_device, traffic), dim_channel=load_channel(w.dim_channel, traffic))


def stage(df: DataFrame) -> DataFrame:
    """Materialise a batch once (a staging table in the shared checkpoint directory): every dimension, the
    fact and the touched dates read it, and key assignment reads it twice, so the upstream work (parsing,
    joins) is not repeated."""
    return materialize(df, "stage")


def _parallel(*thunks):
    """Run independent branches as concurrent Spark jobs (the scheduler interleaves their tasks), the way
    the original schedule runs location ‖ SKU, device ‖ channel and sales ‖ traffic side by side."""
    live = [t for t in thunks if t is not None]
    if len(live) <= 1:
        return [t() for t in live]
    with ThreadPoolExecutor(max_workers=len(live)) as pool:
        return [f.result() for f in [pool.submit(t) for t in live]]


def _merge_fact(current: DataFrame, batch: DataFrame, key: str, part: str, name: str, at: State | None, keep) -> tuple[DataFrame, list]:
    """Upsert a batch, one row a key, into a date-partitioned fact: the new fact, and the days that it changes.  Only the touched
    partitions are joined.  In a stored warehouse the touched partitions get new folders, which ``at`` names; without one the
    untouched partitions pass through, and a batch that meets no rows is the new fact as it was kept."""
    if at is None and current.isEmpty():
        return batch.select(*current.columns), [r[0] for r in batch.select(part).distinct().collect()]
    rows, parts = merge_touched(current, batch, [key], ["created_at"], part, deduped=True)
    if at is None:
        hit = in_parts(part, parts)
        return keep(current.where(~hit | hit.isNull()).unionByName(rows), name), parts
    put_partitions(at, name, rows, part, parts)
    return read_table(batch.sparkSession, at, name, current.schema), parts


def _with_pending(batch: DataFrame, pending: DataFrame, key: str, other_key: str) -> DataFrame:
    """A batch and the rows that earlier loads could not resolve, with the number of attempts so far.  An order that waits
    because it had no lines is dropped when lines of it arrive."""
    staged = batch.withColumn("attempts", F.lit(0))
    waiting = pending.select(*staged.columns)
    if key != other_key:
        arrived = batch.where(F.col(key).isNotNull()).select(F.col(other_key).alias("__arrived")).distinct()
        empty = waiting.where(F.col(key).isNull()).join(arrived, F.col(other_key) == F.col("__arrived"), "left_anti")
        waiting = waiting.where(F.col(key).isNotNull()).unionByName(empty)
    return staged.unionByName(waiting)


def _refuse(bad: DataFrame, what: str, keys: list[str]) -> None:
    few = bad.limit(5).select(keys[0], missing_keys(keys).alias("reason")).collect()
    if few:
        raise UnresolvedKeyError(f"{what} without a key: {few}")


def run_batch(spark: SparkSession, w: Warehouse, orders: DataFrame | None, traffic: DataFrame | None,
              fact_mode: str = "active", persist: bool = True, staged: bool = False,
              root: str | None = None, summary: bool | str = True, on_unresolved: str = "quarantine", include: str = "orders") -> Warehouse:
    """Load one batch into the warehouse and return the new state.

    Empty or missing inputs skip their branch.  Rows whose keys can't be resolved go to the quarantine as they were staged, and
    each later batch tries them again with its new dimension versions (``on_unresolved="fail"`` raises instead, as a NOT NULL
    constraint would, and nothing of the batch is published).  The summary is rebuilt for every day whose facts may have changed:
    the days that the merges touched.  ``include="either"`` also keeps days that have sessions only.  With ``persist=True``
    each new table is written once, so later batches start from files, not lineage.  Type-0 dimensions need no extra write: their
    new rows already come from the key assignment's files.  ``staged=True`` says the inputs are already materialised (or cheap
    filters of materialised tables).  ``summary=False`` leaves the daily summary as it was (for callers that only need the facts);
    ``summary="delta"`` changes it by the rows that the batch inserts and replaces (:mod:`starload.plans.deltas`), which reads no other
    row of the facts: use it from the first batch on, because it needs the state of all batches before.

    With ``root`` the warehouse lives on storage (:mod:`starload.plans.commits`): facts are partitioned by date there and each batch
    rewrites only the partitions it touches; dimensions, quarantines and the summary are rewritten whole (they are small).  All
    tables of a batch appear with one commit.  Start from ``load_warehouse(spark, root)`` (or ``empty_warehouse`` for the first).
    """
    if on_unresolved not in ("quarantine", "fail"):
        raise ValueError("on_unresolved must be 'quarantine' or 'fail'")
    checkpoint_dir(spark)
    at = None if root is None else state(spark, root).next()
    keep = (lambda df, name: materialize(df, name)) if persist else (lambda df, name: df)
    if not staged:
        orders, traffic = _parallel(
            (lambda: stage(orders)) if orders is not None else (lambda: None),
            (lambda: stage(traffic)) if traffic is not None else (lambda: None))
    written: set = set()

    def put(df, name):
        """A table that is rewritten whole: kept, or in a stored warehouse written to its folder, which the commit will name."""
        if at is None:
            return keep(df, name)
        put_table(at, name, df)
        written.add(name)
        return read_table(spark, at, name, df.schema)

    has_orders = orders is not None and not orders.isEmpty()
    has_traffic = traffic is not None and not traffic.isEmpty()
    touched: set = set()
    signed: dict[str, DataFrame] = {}

    def sales_branch():
        batch = orders.select(*STG_ORDERS.names)
        loc, cust, sku = _parallel(lambda: load_location(w.dim_location, batch),
                                   lambda: put(load_customer(w.dim_customer, batch), "dim_customer"),
                                   lambda: put(load_sku(w.dim_sku, batch), "dim_sku"))
        lines = one_per_line(_with_pending(batch, w.quarantine_sales, "line_item_id", "order_id"))
        resolved = keep(resolve_sales(lines, loc, cust, sku, fact_mode, deduped=True), "fct_sales_batch")
        sales, bad = split_resolved(resolved, SALES_KEYS)
        if on_unresolved == "fail":
            _refuse(bad, "sales lines", SALES_KEYS)

        def rest():
            if bad.isEmpty():
                return empty_frame(spark, QUARANTINE_SALES)
            return put(quarantined(lines, bad, "line_item_id", "order_id", SALES_KEYS).select(*QUARANTINE_SALES.names), "quarantine_sales")

        waiting, (fct, days) = _parallel(rest, lambda: _merge_fact(
            w.fct_sales, sales, "line_item_id", "order_date_id", "fct_sales", at, keep))
        touched.update(days)
        signed["sales"] = signed_rows(w.fct_sales, sales, "line_item_id", "order_date_id", days)
        return dict(dim_location=loc, dim_customer=cust, dim_sku=sku, fct_sales=fct, quarantine_sales=waiting)

    def traffic_branch():
        batch = traffic.select(*STG_TRAFFIC.names)
        dev, chn = _parallel(lambda: load_device(w.dim_device, batch), lambda: load_channel(w.dim_channel, batch))
        visits = one_per_session(_with_pending(batch, w.quarantine_traffic, "session_id", "session_id"))
        t, bad = split_resolved(keep(resolve_traffic(visits, chn, dev, deduped=True), "fct_traffic_batch"), TRAFFIC_KEYS)
        if on_unresolved == "fail":
            _refuse(bad, "sessions", TRAFFIC_KEYS)

        def rest():
            if bad.isEmpty():
                return empty_frame(spark, QUARANTINE_TRAFFIC)
            return put(quarantined(visits, bad, "session_id", "session_id", TRAFFIC_KEYS).select(*QUARANTINE_TRAFFIC.names), "quarantine_traffic")

        waiting, (fct, days) = _parallel(rest, lambda: _merge_fact(
            w.fct_traffic, t, "session_id", "visit_date_id", "fct_traffic", at, keep))
        touched.update(days)
        signed["traffic"] = signed_rows(w.fct_traffic, t, "session_id", "visit_date_id", days)
        return dict(dim_device=dev, dim_channel=chn, fct_traffic=fct, quarantine_traffic=waiting)

    changes = {}
    for part in _parallel(sales_branch if has_orders else None, traffic_branch if has_traffic else None):
        changes.update(part)
    if not changes:
        return w
    before, w = w, replace(w, **changes)
    dates = sorted(d for d in touched if d is not None)
    if summary == "delta" and dates:
        days, counts = change_days(before.summary_days, before.summary_values, signed.get("sales"), signed.get("traffic"), w.dim_customer, dates)
        changes["summary_days"] = keep(days, "summary_days")
        changes["fct_periodic_summary"] = summary_of(changes["summary_days"], include)
        if "sales" in signed:
            counts = keep(counts, "summary_values")
            if at is None:
                changes["summary_values"] = before.summary_values.where(~in_parts("date_id", dates)).unionByName(counts)
            else:
                put_partitions(at, "summary_values", counts, "date_id", dates)
                changes["summary_values"] = read_table(spark, at, "summary_values", VALUE_STATE)
        w = replace(w, **changes)
    elif summary and dates:
        days = build_periodic_summary(w.fct_sales, w.fct_traffic, dates, w.dim_customer, include).select(*FCT_PERIODIC_SUMMARY.names)
        # days that lost their last line go with the old rows
        untouched = w.fct_periodic_summary.where(~F.col("date_id").isin(dates)).select(*FCT_PERIODIC_SUMMARY.names)
        changes["fct_periodic_summary"] = keep(untouched.unionByName(days), "fct_periodic_summary")
        w = replace(w, fct_periodic_summary=changes["fct_periodic_summary"])
    if at is None:
        return w
    for name in sorted(set(changes) - {"fct_sales", "fct_traffic", "summary_values"} - written):
        put_table(at, name, getattr(w, name))
    commit(spark, at)
    stored = {name: read_table(spark, at, name, getattr(w, name).schema) for name in changes}
    return replace(w, **stored)


def revenue_by_day_and_country(w: Warehouse) -> DataFrame:
    """Flagship report: revenue, quantity and lines per order day and country."""
    loc = w.dim_location.select("location_id", "country")
    return (w.fct_sales.join(loc, "location_id")
            .groupBy(F.col("order_date_id").alias("date_id"), "country")
            .agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").cast("bigint").alias("quantity"),
                 F.sum("revenue").cast("decimal(18,2)").alias("revenue")))
