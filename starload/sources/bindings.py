"""Stand-in inputs built from the driver's test tables (FIXTURES.md §2).

These frames only give rows in the staging schema; none of the library's work happens here.  Each binding
exists twice: as Spark DataFrame code and as DuckDB SQL text (a CTE the oracle queries start from).  The
Spark side reads only the columns it needs, so the parquet scans are pruned.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.schemas import COORD, MONEY, STG_ORDERS, STG_TRAFFIC
from starload.functions.ids import padded_id
from starload.session import materialize

# Fixed values of the bindings: 2024-01-01 00:00:00 UTC, one day in seconds, the batch boundaries (day 15 ends
# batch 1, day 14 starts batch 2, so day 14 is replayed).
EPOCH_BASE = 1704067200
DAY = 86400
BATCH1_END = EPOCH_BASE + 15 * DAY
BATCH2_START = EPOCH_BASE + 14 * DAY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stg_orders(spark: SparkSession, sf_dir: str, parts_last: bool = False) -> DataFrame:
    """One row per sales line, flat, in the staging schema.  With ``parts_last`` lines meet their orders first and are moved with the
    names of customers, which are shorter than what is known of parts; else lines of an order come out together."""
    li = (table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                        "l_quantity"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", F.col("p_size").cast("string").alias("size"), "p_type",
                                            F.col("p_retailprice").cast(MONEY).alias("price"))
    p = p.withColumn("cogs", (F.col("price") * F.lit(0.6).cast("decimal(1,1)")).cast(MONEY))
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    n = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_name", "r_name",
        (F.col("n_nationkey") * F.lit(1.5).cast("decimal(2,1)")).cast(COORD).alias("latitude"),
        (F.lit(100) - F.col("n_nationkey") * F.lit(2.25).cast("decimal(3,2)")).cast(COORD).alias("longitude"))
    # lines are moved twice only: narrow ones to their parts, then to their orders, which have their customers by then; decimals are
    # made where there are the fewest rows of them
    same_order, same_type = li.l_orderkey == o.o_orderkey, li.schema["l_orderkey"].dataType == o.schema["o_orderkey"].dataType
    if not parts_last and same_type:
        # by their text, which is the order's id: who groups lines by it finds them dealt by it, and wide lines aren't moved again
        same_order = li.l_orderkey.cast("string") == o.o_orderkey.cast("string")
    joins = [(p, li.l_partkey == p.p_partkey), (o.join(c, o.o_custkey == c.c_custkey), same_order)]
    j = li
    for other, same in reversed(joins) if parts_last else joins:
        j = j.join(other, same)
    j = j.join(n, c.c_nationkey == n.n_nationkey)
    order = F.col("l_orderkey" if parts_last and same_type else "o_orderkey")  # equal; one of them is moved to the parts
    t = (F.lit(EPOCH_BASE) + (order % 30) * DAY + (order * 37) % DAY).cast("bigint")
    q = F.col("l_quantity").cast("int")
    out = j.select(
        F.concat_ws("-", *[F.col(x).cast("string") for x in ("l_orderkey", "l_linenumber", "l_partkey",
                                                              "l_suppkey")], q.cast("string")).alias("line_item_id"),
        order.cast("string").alias("order_id"),
        padded_id("SKU-", "p_partkey", 8).alias("sku_id"),
        F.col("p_brand").alias("product_id"),
        F.col("p_name").alias("product_name"),
        "size",
        F.col("p_type").alias("color"),
        "price",
        "cogs",
        q.alias("quantity"),
        padded_id("ID-", "c_custkey", 8).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("place"),
        "latitude",
        "longitude",
        t.alias("order_time"),
        t.alias("updated_at"),
    )
    return out.select(*STG_ORDERS.names)


def orders_batch1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch1_of(stg_orders(spark, sf_dir))


def batch1_of(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_time") < BATCH1_END)


def stg_orders_b2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch2_of(stg_orders(spark, sf_dir))


def batch2_of(orders: DataFrame) -> DataFrame:
    """Second batch: later lines, some changed customer names and SKU prices, day 14 replayed with new
    quantities, everything seen one day later."""
    s = orders.where(F.col("order_time") >= BATCH2_START)
    return s.select(
        "line_item_id", "order_id", "sku_id", "product_id", "product_name", "size", "color",
        F.when(F.substring("sku_id", 12, 1) == "5", (F.col("price") * F.lit(1.1).cast("decimal(2,1)")).cast(MONEY))
        .otherwise(F.col("price")).alias("price"),
        "cogs",
        F.when(F.col("order_time") < BATCH1_END, F.col("quantity") + 1).otherwise(F.col("quantity"))
        .cast("int").alias("quantity"),
        "customer_id",
        F.when(F.substring("customer_id", 11, 1) == "0", F.concat("name", F.lit(" v2"))).otherwise(F.col("name"))
        .alias("name"),
        "country", "place", "latitude", "longitude", "order_time",
        (F.col("updated_at") + DAY).alias("updated_at"),
    ).select(*STG_ORDERS.names)


def stg_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per web session, in the staging schema."""
    e = (table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props"))
    u = F.col("user_id")
    et = F.col("event_type")
    out = e.select(
        F.col("event_id").cast("string").alias("session_id"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("visit_time"),
        F.get_json_object("props", "$.k").cast("int").alias("page_views"),
        F.col("value").cast(MONEY).alias("session_duration"),
        F.when(et == "click", 1).otherwise(0).alias("clicks"),
        F.when(et == "view", "Organic").when(et == "click", "Paid").when(et == "purchase", "Direct")
        .when(et == "signup", "Referral").otherwise("Social").alias("traffic_source"),
        F.when(et != "signup", "-").otherwise(F.concat(F.lit("site"), (u % 4).cast("string"), F.lit(".example"))).alias("referral_source"),
        F.when(u % 2 == 0, "Desktop").otherwise("Mobile").alias("device"),
        F.concat(F.lit("system "), (u % 2).cast("string"), F.lit("."), (u % 3 == 0).cast("int").cast("string")).alias("os"),
        F.concat(F.lit("browser "), (u % 5).cast("string")).alias("browser"),
        F.when(et == "purchase", 1).otherwise(0).alias("transactions"),
    )
    return out.select(*STG_TRAFFIC.names)


def traffic_batch1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic_batch1_of(stg_traffic(spark, sf_dir))


def traffic_batch1_of(traffic: DataFrame) -> DataFrame:
    return traffic.where(F.col("visit_time") < BATCH1_END)


def traffic_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic_batch2_of(stg_traffic(spark, sf_dir))


def traffic_batch2_of(traffic: DataFrame) -> DataFrame:
    """Sessions from day 14 on, day 14 replayed with one more page view."""
    s = traffic.where(F.col("visit_time") >= BATCH2_START)
    return s.withColumn("page_views", F.when(F.col("visit_time") < BATCH1_END, F.col("page_views") + 1)
                        .otherwise(F.col("page_views")).cast("int"))


class Inputs:
    """The bindings of one query call.  ``orders`` / ``traffic`` are staged once (written to the shared
    checkpoint folder, as a loader stages a batch before loading it) and every batch is derived from the staged
    table, so the test-table joins run once per call however many steps read them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def orders(self) -> DataFrame:
        return materialize(stg_orders(self.spark, self.sf_dir, parts_last=True), "stg_orders")

    @cached_property
    def traffic(self) -> DataFrame:
        return materialize(stg_traffic(self.spark, self.sf_dir), "stg_traffic")

    @property
    def orders_b1(self) -> DataFrame:
        return batch1_of(self.orders)

    @property
    def orders_b2(self) -> DataFrame:
        return batch2_of(self.orders)

    @property
    def traffic_b1(self) -> DataFrame:
        return traffic_batch1_of(self.traffic)

    @property
    def traffic_b2(self) -> DataFrame:
        return traffic_batch2_of(self.traffic)


# ----------------------------------------------------------------------------------------------------------
# The same bindings as DuckDB SQL, for the oracle.
# ----------------------------------------------------------------------------------------------------------

SQL_STG_ORDERS = f"""
select concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar), cast(l_partkey as varchar),
                 cast(l_suppkey as varchar), cast(cast(l_quantity as int) as varchar)) line_item_id,
  cast(o_orderkey as varchar) order_id,
  concat('SKU-', lpad(cast(p_partkey as varchar), greatest(8, length(cast(p_partkey as varchar)))::int, '0')) sku_id, p_brand product_id, p_name product_name,
  cast(p_size as varchar) size, p_type color,
  cast(p_retailprice as decimal(12,2)) price,
  cast(cast(p_retailprice as decimal(12,2))*0.6 as decimal(12,2)) cogs,
  cast(l_quantity as int) quantity,
  concat('ID-', lpad(cast(c_custkey as varchar), greatest(8, length(cast(c_custkey as varchar)))::int, '0')) customer_id, c_name name,
  r_name country, n_name place,
  cast(n_nationkey*1.5 as decimal(12,5)) latitude, cast(100-n_nationkey*2.25 as decimal(12,5)) longitude,
  cast({EPOCH_BASE} + (o_orderkey % 30)*{DAY} + (o_orderkey*37) % {DAY} as bigint) order_time,
  cast({EPOCH_BASE} + (o_orderkey % 30)*{DAY} + (o_orderkey*37) % {DAY} as bigint) updated_at
from lineitem join orders on l_orderkey=o_orderkey join customer on o_custkey=c_custkey
  join part on l_partkey=p_partkey join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey
"""

SQL_STG_ORDERS_B2 = f"""
select line_item_id, order_id, sku_id, product_id, product_name, size, color,
  case when substr(sku_id,12,1)='5' then cast(price*1.1 as decimal(12,2)) else price end price, cogs,
  cast(case when order_time < {BATCH1_END} then quantity+1 else quantity end as int) quantity,
  customer_id, case when substr(customer_id,11,1)='0' then concat(name,' v2') else name end name,
  country, place, latitude, longitude, order_time, updated_at+{DAY} updated_at
from stg_orders where order_time >= {BATCH2_START}
"""

SQL_STG_TRAFFIC = """
select cast(event_id as varchar) session_id, cast(floor(epoch(ts)) as bigint) visit_time,
  cast(json_extract_string(props,'$.k') as int) page_views,
  cast(value as decimal(12,2)) session_duration,
  case when event_type='click' then 1 else 0 end clicks,
  case event_type when 'view' then 'Organic' when 'click' then 'Paid' when 'purchase' then 'Direct'
                  when 'signup' then 'Referral' else 'Social' end traffic_source,
  case when event_type<>'signup' then '-' else concat('site', user_id % 4, '.example') end referral_source,
  case when user_id % 2=0 then 'Desktop' else 'Mobile' end device,
  concat('system ', user_id % 2, '.', (user_id % 3 = 0)::int) os,
  concat('browser ', user_id % 5) browser,
  case when event_type='purchase' then 1 else 0 end transactions
from events
"""

SQL_BATCHES = f"""
orders_b1 as (select * from stg_orders where order_time < {BATCH1_END}),
traffic_b1 as (select * from stg_traffic where visit_time < {BATCH1_END}),
traffic_b2 as (select * exclude (page_views),
                 cast(case when visit_time < {BATCH1_END} then page_views + 1 else page_views end as int) page_views
               from stg_traffic where visit_time >= {BATCH2_START})
"""


def sql_with(*ctes: str) -> str:
    """``with stg_orders as (...), stg_orders_b2 as (...), stg_traffic as (...), <ctes>`` prefix."""
    parts = [f"stg_orders as ({SQL_STG_ORDERS})", f"stg_orders_b2 as ({SQL_STG_ORDERS_B2})",
             f"stg_traffic as ({SQL_STG_TRAFFIC})", SQL_BATCHES.strip()]
    parts += [c.strip() for c in ctes if c and c.strip()]
    return "with " + ",\n".join(parts) + "\n"
