"""Top products per city: orders x users x products, top N by revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.operators.windows import topn_per_group

MART_COLUMNS = ["city", "product_id", "product_name", "orders_cnt", "qty_sum", "revenue_sum"]


def enrich_orders(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Orders with revenue = qty x price and the buyer's city (inner join)."""
    return (orders.withColumn("revenue", F.col("qty") * F.col("price"))
            .join(users.select("user_id", "city"), "user_id", "inner"))


def city_product_totals(enriched: DataFrame, products: DataFrame) -> DataFrame:
    """Order count, quantity and revenue per (city, product).

    Aggregated on (city, product_id) before the product dimension is joined:
    the name depends on the id only, so the join touches one row per pair
    instead of one per order line.
    """
    agg = enriched.groupBy("city", "product_id").agg(
        F.count("order_id").alias("orders_cnt"),
        F.sum("qty").alias("qty_sum"),
        F.sum("revenue").alias("revenue_sum"))
    return agg.join(products.select("product_id", "product_name"), "product_id", "inner")


def city_top_products(users: DataFrame, orders: DataFrame, products: DataFrame,
                      n: int = 2) -> DataFrame:
    """The ``n`` products of highest revenue per city; ties go to the lower
    product id."""
    totals = city_product_totals(enrich_orders(orders, users), products)
    top = topn_per_group(totals, "city",
                         [F.col("revenue_sum").desc(), F.col("product_id").asc()], n)
    return top.select(*MART_COLUMNS)
