"""Transaction facts: sales lines and web sessions resolved against their dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.dates import date_id
from starload.operators.lookup import lookup, lookup_asof
from starload.operators.merge import dedupe_stored
from starload.schemas import AMOUNT, FCT_SALES, FCT_TRAFFIC
from starload.session import materialize

LOCATION_KEYS = ["place", "country", "latitude", "longitude"]
SKU_ATTRS = ["product_id", "product_name", "size", "color", "price", "cogs"]
CHANNEL_KEYS = ["traffic_source", "referral_source"]
DEVICE_KEYS = ["device_name", "os", "browser"]
DEVICE_SRC = ["device", "os", "browser"]

# What a missing key is called in the quarantine.
REASONS = {"sku_id": "no SKU version", "customer_id": "no customer version", "location_id": "no location", "channel_id": "no channel",
           "device_id": "no device", "line_item_id": "no line", "session_id": "no session id"}


class UnresolvedKeyError(ValueError):
    """A batch has rows without a dimension key (strict mode)."""


SALES_FKS = ["sku_id", "customer_id", "location_id"]
SALES_KEYS = ["line_item_id", *SALES_FKS]  # what a fact row must have
TRAFFIC_FKS = ["channel_id", "device_id"]
TRAFFIC_KEYS = ["session_id", *TRAFFIC_FKS]


def one_per_line(lines: DataFrame, part: Column | None = None) -> DataFrame:
    """The latest row of each line; an order with an empty item list has one row without a line: kept, one for each order, for the
    quarantine."""
    alone = lines.withColumn("__alone", F.when(F.col("line_item_id").isNull(), F.col("order_id")))
    return dedupe_stored(alone, ["line_item_id", "__alone"], "updated_at", part).drop("__alone")


def one_per_session(visits: DataFrame) -> DataFrame:
    return dedupe_stored(visits, ["session_id"], "visit_time")


def _resolve_sales(stg: DataFrame, dim_location: DataFrame, dim_customer: DataFrame, dim_sku: DataFrame,
                   mode: str, deduped: bool = False) -> DataFrame:
    batch = stg
    stg = stg if deduped else one_per_line(stg, F.floor(F.col("order_time") / 86400) if mode == "asof" else None)
    f = lookup(stg, dim_location, LOCATION_KEYS, LOCATION_KEYS, "location_id")
    # SKUs first: their attributes are most of a line, and go before it is moved again; times go as seconds, which are mostly alike
    if mode == "active":
        f = _lookup_sku_active(f, dim_sku)
        f = _lookup_customer_active(f, dim_customer).withColumn("__t", F.timestamp_seconds("order_time"))
    elif mode == "asof":
        at = F.timestamp_seconds("order_time")
        f = f.select("line_item_id", "order_id", "sku_id", "customer_id", "location_id", "order_time", "quantity", "price", "cogs", "updated_at")
        f = lookup_asof(f, dim_sku.withColumnRenamed("sku_id", "__sku_sk"), "sku_id", "sku_bk", "__sku_sk", at,
                        keys=batch.select("sku_id"))
        f = lookup_asof(materialize(f.drop("sku_id"), "sku_versions"), dim_customer.withColumnRenamed("customer_id", "__customer_sk"), "customer_id",
                        "customer_bk", "__customer_sk", at, keys=batch.select("customer_id")).withColumn("__t", at)
    else:
        raise ValueError(f"mode must be 'active' or 'asof', not {mode!r}")
    return f.select(
        "line_item_id", "order_id",
        F.col("__sku_sk").alias("sku_id"), F.col("__customer_sk").alias("customer_id"), "location_id",
        date_id(F.col("__t")).alias("order_date_id"),
        F.col("__t").alias("order_time"),
        F.col("quantity").cast("int").alias("quantity"),
        (F.col("price") * F.col("quantity")).cast(AMOUNT).alias("revenue"),
        ((F.col("price") - F.col("cogs")) * F.col("quantity")).cast(AMOUNT).alias("gross_profit"),
        F.timestamp_seconds("updated_at").alias("created_at"),
        F.timestamp_seconds("updated_at").alias("updated_at"),
    )


def _lookup_customer_active(f: DataFrame, dim_customer: DataFrame) -> DataFrame:
    d = dim_customer.withColumnRenamed("customer_id", "__customer_sk")
    return lookup(f, d, ["customer_id", "name"], ["customer_bk", "customer_name"], "__customer_sk",
                  active_only=True)


def _lookup_sku_active(f: DataFrame, dim_sku: DataFrame) -> DataFrame:
    d = dim_sku.withColumnRenamed("sku_id", "__sku_sk")
    return lookup(f, d, ["sku_id", *SKU_ATTRS], ["sku_bk", *SKU_ATTRS], "__sku_sk", active_only=True)


def split_resolved(resolved: DataFrame, fks: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every key set, rows with at least one key missing)."""
    ok = F.lit(True)
    for k in fks:
        ok = ok & F.col(k).isNotNull()
    return resolved.where(ok), resolved.where(~ok)


def missing_keys(row_keys: list[str]) -> Column:
    """Why a resolved row is not a fact: the names of its missing keys."""
    return F.concat_ws("; ", *[F.when(F.col(k).isNull(), F.lit(REASONS[k])) for k in row_keys])


def quarantined(staged: DataFrame, bad: DataFrame, key: str, other_key: str, row_keys: list[str]) -> DataFrame:
    """The staged rows (with ``attempts``, one row for each ``key``, or for each ``other_key`` where that is missing) behind the unresolved
    fact rows ``bad``, with the reason and one more attempt.  ``bad`` is what could not be loaded, small as a rule, and
    is joined with the staged batch instead of dragging all staged columns through the lookups."""
    why = bad.select(F.col(key).alias("__k"), F.col(other_key).alias("__o"), missing_keys(row_keys).alias("reason")).distinct()
    same = F.col(key).eqNullSafe(F.col("__k")) & (F.col("__k").isNotNull() | F.col(other_key).eqNullSafe(F.col("__o")))
    hit = staged.join(why, same).drop("__k", "__o")
    hit = hit if key != other_key else hit.where(F.col(key).isNotNull())
    return hit.withColumn("attempts", F.col("attempts") + 1)


def build_fct_sales(stg_orders: DataFrame, dim_location: DataFrame, dim_customer: DataFrame, dim_sku: DataFrame,
                    mode: str = "active") -> tuple[DataFrame, DataFrame]:
    """Sales lines -> (fact rows with every key resolved, lines with an unresolved key).  The lines are read more than once: stage
    them first.

    ``mode="active"`` matches the current version on key and attributes, as the load statement does;
    ``mode="asof"`` picks the version valid at the order time, so late lines find the version they belong to.
    A line whose key cannot be resolved is quarantined instead of producing a NULL foreign key, and so is an order
    without lines instead of producing a fact row without an id.
    """
    return split_resolved(resolve_sales(stg_orders, dim_location, dim_customer, dim_sku, mode), SALES_KEYS)


def resolve_sales(stg_orders: DataFrame, dim_location: DataFrame, dim_customer: DataFrame, dim_sku: DataFrame,
                  mode: str = "active", deduped: bool = False) -> DataFrame:
    """Every (deduplicated) sales line in the fact's shape, foreign keys NULL where unresolved.  ``deduped`` lines are :func:`one_per_line`."""
    return _resolve_sales(stg_orders, dim_location, dim_customer, dim_sku, mode, deduped).select(*FCT_SALES.names)


def unresolved_sales(stg_orders: DataFrame, dim_location: DataFrame, dim_customer: DataFrame, dim_sku: DataFrame,
                     mode: str = "active") -> DataFrame:
    """The quarantine: each unresolved line with a flag per foreign key."""
    _, bad = build_fct_sales(stg_orders, dim_location, dim_customer, dim_sku, mode)
    return bad.select("line_item_id", "order_id", *[F.col(k).isNull().alias(f"missing_{k}") for k in SALES_FKS])


def build_fct_traffic(stg_traffic: DataFrame, dim_channel: DataFrame, dim_device: DataFrame
                      ) -> tuple[DataFrame, DataFrame]:
    """Sessions -> (fact rows with channel and device resolved, sessions with an unresolved key)."""
    return split_resolved(resolve_traffic(stg_traffic, dim_channel, dim_device), TRAFFIC_KEYS)


def resolve_traffic(stg_traffic: DataFrame, dim_channel: DataFrame, dim_device: DataFrame, deduped: bool = False) -> DataFrame:
    """Every (deduplicated) session in the fact's shape, foreign keys NULL where unresolved."""
    stg = stg_traffic if deduped else one_per_session(stg_traffic)
    f = stg.withColumn("__t", F.timestamp_seconds("visit_time"))
    f = lookup(f, dim_channel, CHANNEL_KEYS, CHANNEL_KEYS, "channel_id")
    f = lookup(f, dim_device, DEVICE_SRC, DEVICE_KEYS, "device_id")
    f = f.select(
        "session_id", "channel_id", "device_id",
        date_id(F.col("__t")).alias("visit_date_id"),
        F.col("__t").alias("visit_time"),
        F.col("page_views").cast("int").alias("page_views"),
        F.col("session_duration").cast(AMOUNT).alias("session_duration"),
        F.col("clicks").cast("int").alias("clicks"),
        F.col("transactions").cast("int").alias("transactions"),
        F.col("__t").alias("created_at"),
        F.col("__t").alias("updated_at"),
    )
    return f.select(*FCT_TRAFFIC.names)
