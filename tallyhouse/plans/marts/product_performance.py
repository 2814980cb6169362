"""Sales, reviews, returns and wishes per product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import half_up, money, or_zero, total
from tallyhouse.plans.marts.shared import Tables, product_tree


def product_performance(tables: Tables, as_of: str | None = None) -> DataFrame:
    """One row per product. A returned order counts once per line of the product."""
    items = tables["order_items"]
    sales = items.groupBy("product_id").agg(
        F.sum("quantity").alias("total_sold"),
        total(F.sum("amount")).alias("total_revenue"),
        money(half_up(F.sum("unit_price"), F.count("unit_price"), 2)).alias("avg_unit_price"),
    )
    # Both sides come straight from their tables, so AQE can split an order
    # that holds a large share of the lines.
    returned = (
        items.select("order_id", "product_id")
        .join(tables["order_return"].select("order_id"), "order_id")
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("total_return_events"))
    )
    reviews = tables["product_review"].groupBy("product_id").agg(
        half_up(F.sum("rating"), F.count("rating"), 2).cast("decimal(3,2)").alias("avg_rating"),
        F.count(F.lit(1)).alias("total_reviews"),
    )
    wishes = (
        tables["wishlist"]
        .filter("is_active")
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("total_wishlist_adds"))
    )
    brands = tables["brand"].select(F.col("id").alias("brand_id"), F.col("name").alias("brand_name"))
    joined = product_tree(tables, "brand_id").join(brands, "brand_id", "left")
    for metrics in (sales, reviews, returned, wishes):
        joined = joined.join(metrics, "product_id", "left")
    sold, events = or_zero("total_sold"), or_zero("total_return_events")
    return joined.select(
        "product_id",
        "product_name",
        "brand_name",
        "category_name",
        "sub_category_name",
        sold.alias("total_sold"),
        total(or_zero("total_revenue")).alias("total_revenue"),
        money(or_zero("avg_unit_price")).alias("avg_unit_price"),
        or_zero("avg_rating").cast("decimal(3,2)").alias("avg_rating"),
        or_zero("total_reviews").alias("total_reviews"),
        events.alias("total_return_events"),
        or_zero("total_wishlist_adds").alias("total_wishlist_adds"),
        F.when(sold > 0, F.try_divide(events.cast("double"), sold.cast("double")))
        .otherwise(0.0)
        .alias("return_rate"),
    )
