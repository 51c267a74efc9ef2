"""Orders taken apart into the products they name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.config import CATEGORY_SHARE, PRODUCT_PATTERNS
from clientele.functions.text import like_any
from clientele.operators.joins import literal_rows, match_ids
from clientele.operators.shares import share_of_sum


def item_sales(invoices: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order and product of its id list, with the product's list price."""
    return match_ids(invoices, "product_ids", items, "product_id")


def item_sale_allocation(invoices: DataFrame, items: DataFrame) -> DataFrame:
    """Split each order total over its products in proportion to their list prices."""
    lines = item_sales(
        invoices.select("order_id", "product_ids", "inv_total"),
        items.select("product_id", "product_price"),
    )
    shared = share_of_sum(lines, "order_id", "product_price", "price_share")
    return shared.select(
        F.col("order_id").alias("invoice_id"),
        "product_id",
        (F.col("inv_total") * F.col("price_share")).alias("est_price"),
    )


def product_category(
    products: DataFrame,
    patterns: Iterable[str] = PRODUCT_PATTERNS,
    shares: list[tuple[str, str]] = CATEGORY_SHARE,
) -> DataFrame:
    """Class a product by words in its name and add the revenue share of its class."""
    cat = F.when(like_any("product_name", patterns), "Product").otherwise("Live_training")
    table = literal_rows(products.sparkSession, shares, "category string, share string").select(
        "category", F.col("share").cast("decimal(10,2)").alias("percent_revenue")
    )
    return products.withColumn("category", cat).join(F.broadcast(table), "category", "left")
