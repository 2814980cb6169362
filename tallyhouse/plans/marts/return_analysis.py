"""Returns per product: volume, type, status, refunds and rate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.catalog import RETURN_STATUSES, RETURN_TYPES
from tallyhouse.functions import count_where, half_up, money, or_zero, total
from tallyhouse.plans.marts.shared import Tables, product_tree


def return_analysis(tables: Tables, as_of: str | None = None) -> DataFrame:
    """One row per product that occurs in a returned order.

    Lines and returns meet once, by order. A return counts at the first line
    of each of its products, however many lines it has there, so plain sums
    replace distinct counts and nothing is held per order and product.
    """
    per_order, per_line = Window.partitionBy("order_id"), Window.partitionBy("order_id", "product_id")
    returns = tables["order_return"].select(
        "order_id",
        "reason",
        "return_type",
        "status",
        or_zero("refund_amount").alias("_refund"),
        F.datediff("resolved_at", "created_at").alias("_days"),
        F.row_number().over(per_order.orderBy("id")).alias("_nth_return"),
    )
    lines = (
        tables["order_items"]
        .select("order_id", "product_id", "quantity", "amount")
        .repartition("order_id")
        .withColumn("_nth_line", F.row_number().over(per_line.orderBy(F.lit(1))))
    )
    # A return whose order has no line stays, with no product.
    both = returns.join(lines, "order_id", "full")
    returned = F.col("_nth_return").isNotNull()
    counted = returned & (F.col("_nth_line").isNull() | (F.col("_nth_line") == 1))
    first = F.col("_nth_return").isNull() | (F.col("_nth_return") == 1)
    refunds, days = F.sum(F.when(counted, F.col("_refund"))), F.when(counted, F.col("_days"))
    per_product = (
        both.groupBy("product_id")
        .agg(
            count_where(counted).alias("total_returns"),
            count_where(counted & first & F.col("order_id").isNotNull()).alias("distinct_orders_returned"),
            *[count_where(counted & (F.col("return_type") == kind)).alias(f"{kind}_count") for kind in RETURN_TYPES],
            *[count_where(counted & (F.col("status") == state)).alias(f"status_{state}") for state in RETURN_STATUSES],
            total(refunds).alias("total_refund_amount"),
            money(half_up(refunds, count_where(counted), 2)).alias("avg_refund_amount"),
            half_up(F.sum(days), F.count(days), 1).cast("double").alias("avg_resolution_days"),
            F.sum(F.when(returned, or_zero("quantity"))).alias("total_quantity_in_returned_orders"),
            total(F.sum(F.when(returned, or_zero("amount")))).alias("total_revenue_in_returned_orders"),
            F.count(F.when(counted, F.col("reason"))).alias("total_reason_entries"),
            count_where((F.col("_nth_line") == 1) & first).alias("_ordered"),
        )
        .filter("total_returns > 0")
    )
    rate = half_up(F.col("distinct_orders_returned"), F.col("total_product_orders"), 4)
    return (
        per_product.join(product_tree(tables), "product_id", "left")
        .withColumn("total_product_orders", F.when(F.col("product_id").isNotNull(), F.col("_ordered")))
        .drop("_ordered")
        .withColumn(
            "return_rate",
            F.when(F.col("total_product_orders") > 0, rate).otherwise(0).cast("double"),
        )
    )


def top_return_reasons(order_return: DataFrame, k: int | None = None) -> DataFrame:
    """Reasons by number of returns, most frequent first; ``k`` keeps the top ones."""
    ranked = (
        order_return.groupBy("reason")
        .agg(F.count(F.lit(1)).alias("reason_count"))
        .orderBy(F.desc("reason_count"), "reason")
    )
    return ranked.limit(k) if k else ranked
