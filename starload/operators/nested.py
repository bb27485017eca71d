"""Nested documents: rows <-> orders with an array of line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.schemas import ITEM_FIELDS, ORDER_FIELDS


def nest_orders(flat: DataFrame, order_key: str = "order_id", item_fields=ITEM_FIELDS,
                order_fields=ORDER_FIELDS, version_col: str = "updated_at") -> DataFrame:
    """Flat lines -> one row per order with ``item_list: array<struct>``.

    Order attributes come from the order's latest line by ``version_col`` (deterministic, unlike "last");
    items are sorted by their first field so the document does not depend on shuffle order.  Both are
    aggregate functions with map-side partial aggregation.
    """
    attrs = [c for c in order_fields if c != order_key]
    head = F.max_by(F.struct(*[F.col(c) for c in attrs]), F.col(version_col)).alias("__h")
    items = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in item_fields]))).alias("item_list")
    return (flat.groupBy(order_key).agg(head, items)
            .select(order_key, *[F.col(f"__h.{c}").alias(c) for c in attrs], "item_list")
            .select(*order_fields[:-1], "item_list", order_fields[-1]))


def explode_items(nested: DataFrame, items: str = "item_list") -> DataFrame:
    """One row per item with the item's fields as columns; an order with an empty or NULL list keeps one
    row with NULL item fields (``explode_outer``)."""
    others = [c for c in nested.columns if c != items]
    return nested.select(*others, F.explode_outer(items).alias("__item")).select(*others, "__item.*")
