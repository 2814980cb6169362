"""Cart funnel per channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.catalog import CART_STATUSES
from tallyhouse.functions import count_where, half_up, money, status_is, total
from tallyhouse.plans.marts.shared import Tables


def cart_analytics(tables: Tables, as_of: str | None = None) -> DataFrame:
    """One row per channel; a single aggregation over the carts."""
    carts = tables["cart"].groupBy("channel").agg(
        F.count(F.lit(1)).alias("total_carts"),
        *[count_where(status_is("status", name)).alias(f"{name}_carts") for name in CART_STATUSES],
        total(F.sum("total_amount")).alias("total_cart_value"),
        money(half_up(F.sum("total_amount"), F.count("total_amount"), 2)).alias("avg_cart_value"),
        half_up(F.sum("item_count"), F.count("item_count"), 2).cast("double").alias("avg_items_per_cart"),
    )

    def rate(part: str):
        return half_up(F.col(part) * 100, F.col("total_carts"), 2).cast("double")

    return carts.withColumns(
        {"cart_abandonment_rate": rate("abandoned_carts"), "cart_conversion_rate": rate("checked_out_carts")}
    )
