"""Landing zone: nested JSON in, typed and validated staging frames out.

Files are JSON Lines, one order (or session) per line, partitioned by batch key ``batch=yyyyMMddHHmm``.
A whole batch in one JSON document would make one task parse the whole batch; one record per line splits
freely.  The enveloped form ``{"order_count": n, "orders": [...]}`` is still readable (``envelope=True``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from starload.schemas import (
    COORD,
    MONEY,
    RAW_HOLIDAY,
    RAW_ORDER,
    RAW_ORDERS_DOCUMENT,
    RAW_TRAFFIC_DOCUMENT,
    RAW_VISIT,
    STG_ORDERS,
    STG_TRAFFIC,
    empty_frame,
)


class InvalidRecordError(ValueError):
    """Raised by ingest with ``on_invalid="fail"`` when any record is invalid."""


# ------------------------------------------------------------------------------------------------- writing

def land(df: DataFrame, path: str, batch_col: str = "batch", mode: str = "append", sort_by: str | None = None
         ) -> None:
    """Write records as JSON Lines under ``path/batch=<key>/`` (one directory per extract window).

    Rows are range-partitioned on (batch, ``sort_by``) first: each task then writes a contiguous stretch of
    batches (few files per folder instead of one per task and folder), a batch holding a large share of the
    rows is still split over several tasks by the second column, and files come out ordered by ``sort_by``.
    Without ``sort_by`` the second column is a hash of the record, so a single batch is split as well.  Files are
    gzipped: JSON Lines shrink to about a tenth.
    """
    rest = [F.col(f.name) for f in df.schema.fields if f.name != batch_col and not _has_map(f.dataType)]
    order = [F.col(batch_col), *([F.col(sort_by)] if sort_by else [F.xxhash64(*rest)] if rest else [])]
    df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.write.mode(mode).option("compression", "gzip").partitionBy(batch_col).json(path)


def _has_map(kind: T.DataType) -> bool:
    """Maps have no hash."""
    return "map<" in kind.simpleString()


def replace_table(df: DataFrame, name: str) -> None:
    """Replace a staging table (``if_table_exists="replace"``)."""
    df.write.mode("overwrite").saveAsTable(name)


def create_table_or_fail(df: DataFrame, name: str) -> None:
    """Create a master-data table; fail if it already exists (``if_table_exists="fail"``)."""
    df.write.mode("errorifexists").saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a staging table once its batch is loaded."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})


# ------------------------------------------------------------------------------------------------- reading

#: The files that are read: JSON Lines, plain or gzipped.
FILES = "{*.json,*.json.gz}"
CORRUPT = "malformed"  # the field that a parser fills when a line is no record of the schema


def parse_lines(lines: DataFrame, record_schema: T.StructType) -> DataFrame:
    """JSON Lines (a ``value`` column, others are kept) as records with a fixed schema, with their text in ``raw_record``; a line
    that can't be parsed has NULL fields and ``malformed`` set.  Empty lines are no records."""
    schema = T.StructType([*record_schema.fields, T.StructField(CORRUPT, T.StringType())])
    others = [c for c in lines.columns if c != "value"]
    record = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # exploded, so that a line is parsed once: a filter on parsed fields would be pushed below a projection and parse for every field
    parsed = lines.where(F.trim("value") != "").select("*", F.explode(F.array(record)).alias("__r"))
    return parsed.select(*[F.col(f"__r.{f.name}").alias(f.name) for f in record_schema.fields], *others, F.col("value").alias("raw_record"),
                         (F.col(f"__r.{CORRUPT}").isNotNull() | F.col("__r").isNull()).alias(CORRUPT))


def line_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema of text lines below ``path``: with the batch key, as text, if the files lie in ``batch=`` folders."""
    value, batch = T.StructField("value", T.StringType()), T.StructField("batch", T.StringType())
    found = spark.read.schema(T.StructType([value])).option("pathGlobFilter", FILES).text(path).columns
    return T.StructType([value, batch] if "batch" in found else [value])


def read_landed(spark: SparkSession, path: str, record_schema: T.StructType, envelope: str | None = None,
                document_schema: T.StructType | None = None) -> DataFrame:
    """Read landed JSON with a fixed schema (no inference), only ``*.json`` and ``*.json.gz`` files, keeping the batch key (as text), the source
    file, and each record's text (``raw_record``), so that what is rejected can be looked at and repaired.  ``envelope`` names
    the array field of enveloped documents, which are then read whole (``multiLine``) and exploded; their records' text is
    written anew from the fields of the schema."""
    batch = T.StructField("batch", T.StringType())
    try:
        if envelope:
            r = spark.read.schema(T.StructType([*document_schema.fields, batch])).option("multiLine", "true")
            df = r.option("pathGlobFilter", FILES).json(path).withColumn("source_file", F.col("_metadata.file_path"))
        else:
            r = spark.read.schema(line_schema(spark, path)).option("pathGlobFilter", FILES)
            df = r.text(path).withColumn("source_file", F.col("_metadata.file_path"))
            df = df if "batch" in df.columns else df.withColumn("batch", F.lit(None).cast("string"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        # an empty or missing prefix is an empty batch, not an error
        text = [T.StructField(c, T.StringType()) for c in ("batch", "source_file", "raw_record")]
        return empty_frame(spark, T.StructType([*record_schema.fields, *text, T.StructField(CORRUPT, T.BooleanType())]))
    if not envelope:
        return parse_lines(df, record_schema)
    df = df.select("batch", "source_file", F.explode(envelope).alias("__r"))
    return df.select("__r.*", "batch", "source_file", F.to_json("__r").alias("raw_record"), F.lit(False).alias(CORRUPT))


def read_orders(spark: SparkSession, path: str, envelope: bool = False) -> DataFrame:
    return read_landed(spark, path, RAW_ORDER, "orders" if envelope else None, RAW_ORDERS_DOCUMENT)


def read_traffic(spark: SparkSession, path: str, envelope: bool = False) -> DataFrame:
    return read_landed(spark, path, RAW_VISIT, "visitors" if envelope else None, RAW_TRAFFIC_DOCUMENT)


def read_holidays(spark: SparkSession, path: str, json_array: bool = False) -> DataFrame:
    """Holiday records ``{event_date, event_name, is_national_holiday}``: JSON Lines, or one JSON array per
    file as a holiday service returns it (``json_array=True``)."""
    return spark.read.schema(RAW_HOLIDAY).option("multiLine", str(json_array).lower()).json(path)


# ---------------------------------------------------------------------------------------------- validating

def _int(c: str | Column, kind: str = "bigint") -> Column:
    """Lax integer: '14', 14 and 14.0 are 14; '14.5', 'abc' or a number that ``kind`` can't hold are invalid (NULL)."""
    c = F.col(c) if isinstance(c, str) else c
    d = c.try_cast("decimal(38,6)")
    # plain digits, which nearly all are, need no decimals
    return F.when(c.cast("string").rlike("^-?[0-9]{1,18}$"), c.try_cast(kind)).otherwise(F.when(d == F.floor(d), d.try_cast(kind)))


def _num(c: str, t: T.DataType) -> Column:
    return (F.col(c)).try_cast(t)


def _required(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def _finish(typed: DataFrame, ok: Column, reason: Column, on_invalid: str) -> tuple[DataFrame, DataFrame]:
    t = typed.withColumn("__ok", ok).withColumn("__reason", reason)
    valid = t.where(F.col("__ok")).drop("__ok", "__reason")
    bad = t.where(~F.col("__ok")).withColumnRenamed("__reason", "reason").drop("__ok")
    if on_invalid == "fail":
        if not bad.isEmpty():
            raise InvalidRecordError(f"invalid records: {bad.select('reason').limit(5).collect()}")
    elif on_invalid != "quarantine":
        raise ValueError("on_invalid must be 'quarantine' or 'fail'")
    return valid, bad


#: What is kept about where a record came from.
LINEAGE = ("batch", "source_file", "raw_record", CORRUPT)


def _malformed(raw: DataFrame) -> list[tuple[str, Column]]:
    return [("malformed record", F.col(CORRUPT))] if CORRUPT in raw.columns else []


ORDER_REQUIRED = ["order_id", "customer_id", "order_time", "item_list", "updated_at"]
ITEM_REQUIRED = ["line_item_id", "sku_id", "product_id", "product_name", "size", "color", "price", "cogs",
                 "quantity"]


def validate_orders(raw: DataFrame) -> DataFrame:
    """Type every field of a raw order and add ``__ok`` / ``reason`` (the names of the failed checks).

    An order is valid when its required fields are present and parse, and every item has all nine fields
    present and parseable.  Absent optional fields are NULL; a present optional number that does not parse
    makes the order invalid, as a typed model would reject it.
    """
    item_t = T.StructType([T.StructField(f, STG_ORDERS[f].dataType) for f in ITEM_REQUIRED])
    typed_items = F.transform("item_list", lambda i: F.struct(
        i["line_item_id"].alias("line_item_id"), i["sku_id"].alias("sku_id"), i["product_id"].alias("product_id"),
        i["product_name"].alias("product_name"), i["size"].alias("size"), i["color"].alias("color"),
        (i["price"]).try_cast(MONEY).alias("price"), (i["cogs"]).try_cast(MONEY).alias("cogs"),
        _int(i["quantity"], "int").alias("quantity"),
    ))
    items_present = F.forall(F.col("item_list"), lambda i: _required([i[f] for f in ITEM_REQUIRED]))
    parsed = F.struct(_int("order_time").alias("order_time"), _num("latitude", COORD).alias("latitude"), _num("longitude", COORD).alias("longitude"),
                      typed_items.cast(T.ArrayType(item_t)).alias("item_list"), _int("updated_at").alias("updated_at"))
    # exploded, so that fields are typed once: checks and filters on them would be merged with the projection and type every item again
    once = raw.select("*", items_present.alias("__items_present"), F.explode(F.array(parsed)).alias("__t"))
    typed = once.select(
        "order_id", "customer_id", "__t.order_time", "name", "__t.latitude", "__t.longitude", "place", "country", "__t.item_list", "__t.updated_at",
        *[c for c in LINEAGE if c in raw.columns],
        F.col("latitude").alias("__raw_lat"), F.col("longitude").alias("__raw_lon"), "__items_present",
    )
    checks = [
        *_malformed(raw),
        ("missing order_id", F.col("order_id").isNull()),
        ("missing customer_id", F.col("customer_id").isNull()),
        ("bad order_time", F.col("order_time").isNull()),
        ("bad updated_at", F.col("updated_at").isNull()),
        ("missing item_list", F.col("item_list").isNull()),
        ("bad latitude", F.col("__raw_lat").isNotNull() & F.col("latitude").isNull()),
        ("bad longitude", F.col("__raw_lon").isNotNull() & F.col("longitude").isNull()),
        ("missing item field", F.col("item_list").isNotNull() & ~F.coalesce(F.col("__items_present"), F.lit(True))),
        ("bad item field", F.col("item_list").isNotNull() & F.coalesce(F.col("__items_present"), F.lit(True))
         & ~F.coalesce(_items_parse("item_list"), F.lit(True))),
    ]
    reason = F.concat_ws("; ", *[F.when(c, F.lit(name)) for name, c in checks])
    ok = ~reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for _, c in checks])
    return typed.withColumn("__ok", ok).withColumn("reason", reason).drop("__raw_lat", "__raw_lon", "__items_present")


def _items_parse(col: str) -> Column:
    return F.forall(col, lambda i: _required([i[f] for f in ITEM_REQUIRED]))


def ingest_orders(raw: DataFrame, on_invalid: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Raw orders -> (flat staging lines, quarantined orders with ``reason``).

    Valid orders are flattened with ``explode_outer`` (an order with an empty item list keeps one row with
    NULL item fields).  ``on_invalid="fail"`` raises if any order is invalid, as a strict model would.
    """
    return split_orders(validate_orders(raw), on_invalid)


def split_orders(v: DataFrame, on_invalid: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """What :func:`validate_orders` returns as flat lines and invalid orders (see :func:`ingest_orders`)."""
    good = v.where(F.col("__ok")).drop("__ok", "reason")
    bad = v.where(~F.col("__ok")).drop("__ok")
    if on_invalid == "fail":
        if not bad.isEmpty():
            raise InvalidRecordError(f"invalid orders: {bad.select('order_id', 'reason').limit(5).collect()}")
    elif on_invalid != "quarantine":
        raise ValueError("on_invalid must be 'quarantine' or 'fail'")
    extra = [c for c in ("batch", "source_file") if c in good.columns]
    others = [c for c in good.columns if c != "item_list"]
    flat = good.select(*others, F.explode_outer("item_list").alias("__i")).select(*others, "__i.*")
    return flat.select(*STG_ORDERS.names, *extra), bad


# Defaults for absent visit fields.
VISIT_DEFAULTS = {"clicks": 0, "traffic_source": "Unknown", "referral_source": "-", "device": "Unknown",
                  "os": "Unknown", "browser": "Unknown", "transactions": 0}


def ingest_traffic(raw: DataFrame, on_invalid: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Raw sessions -> (typed staging rows with defaults applied, quarantined sessions with ``reason``).

    Required: session_id, visit_time, page_views, session_duration.  Absent (or JSON null) optional fields
    take their defaults; a present optional number that does not parse is invalid.
    """
    def opt_int(c):
        return F.coalesce(_int(c, "int"), F.lit(VISIT_DEFAULTS[c]))

    typed = raw.select(
        "session_id", _int("visit_time").alias("visit_time"), _int("page_views", "int").alias("page_views"),
        _num("session_duration", MONEY).alias("session_duration"),
        opt_int("clicks").alias("clicks"),
        *[F.coalesce(F.col(c), F.lit(VISIT_DEFAULTS[c])).alias(c)
          for c in ("traffic_source", "referral_source", "device", "os", "browser")],
        opt_int("transactions").alias("transactions"),
        *[c for c in LINEAGE if c in raw.columns],
        F.col("clicks").alias("__raw_clicks"), F.col("transactions").alias("__raw_tx"),
    )
    checks = [
        *_malformed(raw),
        ("missing session_id", F.col("session_id").isNull()),
        ("bad visit_time", F.col("visit_time").isNull()),
        ("bad page_views", F.col("page_views").isNull()),
        ("bad session_duration", F.col("session_duration").isNull()),
        ("bad clicks", F.col("__raw_clicks").isNotNull() & _int("__raw_clicks", "int").isNull()),
        ("bad transactions", F.col("__raw_tx").isNotNull() & _int("__raw_tx", "int").isNull()),
    ]
    reason = F.concat_ws("; ", *[F.when(c, F.lit(n)) for n, c in checks])
    ok = ~reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for _, c in checks])
    valid, bad = _finish(typed, ok, reason, on_invalid)
    extra = [c for c in ("batch", "source_file") if c in valid.columns]
    return valid.select(*STG_TRAFFIC.names, *extra), bad.drop("__raw_clicks", "__raw_tx")
