"""Fixed schemas: landed JSON documents, staging frames, dimensions and facts.

Types follow the warehouse DDL with two deliberate changes: money is ``decimal(12,2)`` at the staging
boundary (exact equality joins and exact sums) and coordinates are ``decimal(12,5)``.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
AMOUNT = T.DecimalType(18, 2)
COORD = T.DecimalType(12, 5)
S = T.StringType()
L = T.LongType()
I = T.IntegerType()
TS = T.TimestampType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- landed JSON, read with every scalar as text so numbers in quotes can be coerced (lax validation) ---
RAW_ITEM = _struct(
    ("line_item_id", S), ("sku_id", S), ("product_id", S), ("product_name", S), ("size", S),
    ("color", S), ("price", S), ("cogs", S), ("quantity", S),
)
RAW_ORDER = _struct(
    ("order_id", S), ("customer_id", S), ("order_time", S), ("name", S), ("latitude", S),
    ("longitude", S), ("place", S), ("country", S), ("item_list", T.ArrayType(RAW_ITEM)), ("updated_at", S),
)
RAW_ORDERS_DOCUMENT = _struct(("order_count", S), ("orders", T.ArrayType(RAW_ORDER)))

RAW_VISIT = _struct(
    ("session_id", S), ("visit_time", S), ("page_views", S), ("session_duration", S), ("clicks", S),
    ("traffic_source", S), ("referral_source", S), ("device", S), ("os", S), ("browser", S),
    ("transactions", S),
)
RAW_TRAFFIC_DOCUMENT = _struct(("visitor_count", S), ("visitors", T.ArrayType(RAW_VISIT)))

RAW_HOLIDAY = _struct(("event_date", S), ("event_name", S), ("is_national_holiday", T.BooleanType()))

# --- staging (typed, flat) ---
ITEM_FIELDS = ["line_item_id", "sku_id", "product_id", "product_name", "size", "color", "price", "cogs", "quantity"]
ORDER_FIELDS = ["order_id", "customer_id", "order_time", "name", "latitude", "longitude", "place", "country",
                "updated_at"]

STG_ORDERS = _struct(
    ("line_item_id", S), ("order_id", S), ("sku_id", S), ("product_id", S), ("product_name", S),
    ("size", S), ("color", S), ("price", MONEY), ("cogs", MONEY), ("quantity", I),
    ("customer_id", S), ("name", S), ("country", S), ("place", S), ("latitude", COORD), ("longitude", COORD),
    ("order_time", L), ("updated_at", L),
)

STG_TRAFFIC = _struct(
    ("session_id", S), ("visit_time", L), ("page_views", I), ("session_duration", MONEY), ("clicks", I),
    ("traffic_source", S), ("referral_source", S), ("device", S), ("os", S), ("browser", S),
    ("transactions", I),
)

# --- what could not be loaded ---
# A rejected record: where it came from, its own key if it has one, what is wrong, and its text.
DEAD_LETTERS = _struct(("feed", S), ("record_key", S), ("batch", S), ("source_file", S), ("reason", S), ("raw_record", S))
# A valid row that finds no key in a dimension: as staged, with the reason and how many loads have tried it.
QUARANTINE_SALES = T.StructType([*STG_ORDERS.fields, T.StructField("reason", S), T.StructField("attempts", I)])
QUARANTINE_TRAFFIC = T.StructType([*STG_TRAFFIC.fields, T.StructField("reason", S), T.StructField("attempts", I)])

# --- warehouse ---
DIM_DATE = T.StructType([
    T.StructField("date_id", I, False), T.StructField("date", T.DateType()),
    T.StructField("full_date_description", S), T.StructField("year", T.ShortType()),
    T.StructField("quarter", T.ShortType()), T.StructField("month", T.ShortType()),
    T.StructField("day", T.ShortType()), T.StructField("day_of_week", T.ShortType()),
    T.StructField("calendar_day_of_week", S), T.StructField("calendar_month", S),
    T.StructField("is_weekend", S), T.StructField("event_name", S), T.StructField("is_holiday", S),
])

SCD2_COLUMNS = ["row_eff_time", "row_exp_time", "current_row_indicator", "updated_at"]

DIM_CUSTOMER = _struct(
    ("customer_id", L), ("customer_bk", S), ("customer_name", S),
    ("row_eff_time", TS), ("row_exp_time", TS), ("current_row_indicator", S), ("updated_at", TS),
)
DIM_SKU = _struct(
    ("sku_id", L), ("sku_bk", S), ("product_id", S), ("product_name", S), ("size", S), ("color", S),
    ("price", MONEY), ("cogs", MONEY),
    ("row_eff_time", TS), ("row_exp_time", TS), ("current_row_indicator", S), ("updated_at", TS),
)
DIM_LOCATION = _struct(("location_id", L), ("country", S), ("place", S), ("longitude", COORD), ("latitude", COORD))
DIM_DEVICE = _struct(("device_id", L), ("device_name", S), ("os", S), ("browser", S))
DIM_CHANNEL = _struct(("channel_id", L), ("traffic_source", S), ("referral_source", S))

FCT_SALES = _struct(
    ("line_item_id", S), ("order_id", S), ("sku_id", L), ("customer_id", L), ("location_id", L),
    ("order_date_id", I), ("order_time", TS), ("quantity", I), ("revenue", AMOUNT), ("gross_profit", AMOUNT),
    ("created_at", TS), ("updated_at", TS),
)
FCT_TRAFFIC = _struct(
    ("session_id", S), ("channel_id", L), ("device_id", L), ("visit_date_id", I), ("visit_time", TS),
    ("page_views", I), ("session_duration", AMOUNT), ("clicks", I), ("transactions", I),
    ("created_at", TS), ("updated_at", TS),
)
FCT_PERIODIC_SUMMARY = _struct(
    ("date_id", I), ("unique_orders", L), ("unique_customers", L), ("quantity", L), ("revenue", AMOUNT),
    ("gross_profit", AMOUNT), ("page_views", L), ("num_sessions", L), ("session_duration", AMOUNT),
    ("clicks", L), ("transactions", L),
)


def empty_frame(spark, schema: T.StructType):
    """An empty DataFrame with ``schema``.  Built from ``range(0)`` so the optimizer sees an empty local
    relation (no tasks, no Python data source) and folds joins and aggregates over it."""
    from pyspark.sql import functions as F

    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
