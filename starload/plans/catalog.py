"""SKU catalogue: every product in every size and colour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.ids import padded_id
from starload.operators.keys import assign_surrogate_keys
from starload.schemas import MONEY

# Sizes with their price adjustment, and colours, in catalogue order.
SIZES = [("S", -2.0), ("M", -1.0), ("L", 1.0), ("XL", 2.0)]
COLORS = ["Black", "White", "Gray", "Pink"]
COGS_RATIO = "0.6"


def build_sku_catalog(products: DataFrame, sizes=SIZES, colors=COLORS) -> DataFrame:
    """``products(product_name, base_price)`` -> one SKU per product x size x colour.

    Sizes and colours are short fixed lists, so each product row is expanded with ``explode`` of a literal
    array (a generator inside the scan's stage, no join).  Product ids number products by name, SKU ids
    number SKUs by (product, size position, colour position), both with the scalable key assignment.
    price = round(base + size adjustment, 2), cogs = round(base * 0.6, 2).
    """
    p = products.select("product_name", F.col("base_price").cast("decimal(12,2)").alias("base_price"))
    p = assign_surrogate_keys(p, ["product_name"], "__pno")
    size_arr = F.array(*[F.struct(F.lit(i).alias("si"), F.lit(s).alias("size"),
                                  F.lit(str(adj)).cast("decimal(4,2)").alias("adj"))
                         for i, (s, adj) in enumerate(sizes)])
    color_arr = F.array(*[F.struct(F.lit(i).alias("ci"), F.lit(c).alias("color")) for i, c in enumerate(colors)])
    x = (p.withColumn("s", F.explode(size_arr)).withColumn("c", F.explode(color_arr))
         .select("__pno", "product_name", "base_price", "s.si", "s.size", "s.adj", "c.ci", "c.color"))
    x = assign_surrogate_keys(x, ["__pno", "si", "ci"], "__sno")
    return x.select(
        padded_id("SKU-", F.col("__sno") - 1, 4).alias("sku_id"),
        padded_id("P-", F.col("__pno") - 1, 4).alias("product_id"),
        "product_name", "size", "color",
        F.round(F.col("base_price") + F.col("adj"), 2).cast(MONEY).alias("price"),
        F.round(F.col("base_price") * F.lit(COGS_RATIO).cast("decimal(2,1)"), 2).cast(MONEY).alias("cogs"),
    )
