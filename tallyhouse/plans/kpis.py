"""Headline ratios. Each is one or two aggregations ending in a single row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import count_where, half_up, money, status_in, status_is, total
from tallyhouse.plans.marts.logistics import shipment_times


def sales_by_channel(daily: DataFrame) -> DataFrame:
    """Roll the daily sales mart up to day and channel: value, average and margin."""
    return (
        daily.groupBy("order_date", "order_channel_id")
        .agg(
            F.sum("total_orders").alias("total_orders"),
            total(F.sum("total_revenue")).alias("gmv"),
            total(F.sum("total_profit")).alias("profit"),
        )
        .withColumns(
            {
                "aov": money(half_up(F.col("gmv"), F.col("total_orders"), 2)),
                "profit_margin": half_up(F.col("profit"), F.col("gmv"), 4).cast("double"),
            }
        )
    )


def order_kpis(orders: DataFrame) -> DataFrame:
    """Gross value, average value, conversion rate and profit margin in one pass."""
    count, value = F.count(F.lit(1)), F.sum("total_price")
    return orders.agg(
        count.alias("orders"),
        total(value).alias("gmv"),
        money(half_up(value, F.count("total_price"), 2)).alias("aov"),
        half_up(F.sum("profit"), value, 4).cast("double").alias("profit_margin"),
    )


def conversion_rate(orders: DataFrame) -> DataFrame:
    completed = count_where(status_is("status", "Completed"))
    return orders.agg(
        completed.alias("completed_orders"),
        F.count(F.lit(1)).alias("orders"),
        half_up(completed, F.count(F.lit(1)), 4).cast("double").alias("conversion_rate"),
    )


def return_rate(orders: DataFrame, order_return: DataFrame) -> DataFrame:
    """Returned orders over delivered orders (delivered, completed or returned)."""
    delivered = orders.filter(status_in("status", "Delivered", "Completed", "Returned")).select("id")
    with_return = order_return.select(F.col("order_id").alias("id")).distinct().withColumn("_returned", F.lit(1))
    flags = delivered.join(with_return, "id", "left")
    returned_orders, all_orders = F.count("_returned"), F.count(F.lit(1))
    return flags.agg(
        returned_orders.alias("returned_orders"),
        all_orders.alias("delivered_orders"),
        half_up(returned_orders, all_orders, 4).cast("double").alias("return_rate"),
    )


def customer_retention_rate(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with more than one order over all customers."""
    counts = orders.groupBy(F.col("customer_id").alias("id")).agg(F.count(F.lit(1)).alias("_orders"))
    repeat = count_where(F.col("_orders") > 1)
    return (
        customers.select("id")
        .join(counts, "id", "left")
        .agg(
            repeat.alias("repeat_customers"),
            F.count(F.lit(1)).alias("customers"),
            half_up(repeat, F.count(F.lit(1)), 4).cast("double").alias("customer_retention"),
        )
    )


def inventory_turnover(inventory: DataFrame, log: DataFrame) -> DataFrame:
    """Per product: units sold over the average stock of its warehouses."""
    sold = F.sum(F.when(F.col("change_type") == "sale", F.abs("quantity_change").cast("bigint")).otherwise(0))
    moved = log.groupBy(F.col("inventory_id").alias("id")).agg(sold.alias("_sold"))
    stock = inventory.select("id", "product_id", "quantity").join(moved, "id", "left")
    units, stocked, rows = F.sum(F.coalesce("_sold", F.lit(0))), F.sum("quantity"), F.count(F.lit(1))
    return stock.groupBy("product_id").agg(
        units.alias("units_sold"),
        half_up(stocked, rows, 2).cast("double").alias("average_stock"),
        half_up(units * rows, stocked, 4).cast("double").alias("inventory_turnover"),
    )


def shipping_sla(shipment: DataFrame) -> DataFrame:
    """Deliveries that kept their promise over all deliveries."""
    on_time = count_where(F.col("is_on_time"))
    delivered = F.count("actual_delivery")
    return shipment_times(shipment).agg(
        on_time.alias("on_time"),
        delivered.alias("delivered"),
        half_up(on_time, delivered, 4).cast("double").alias("shipping_sla"),
    )


def cart_kpis(cart: DataFrame) -> DataFrame:
    """Cart abandonment and cart-to-order rate."""
    abandoned = count_where(status_is("status", "abandoned"))
    checked_out = count_where(status_is("status", "checked_out"))
    created = F.count(F.lit(1))
    return cart.agg(
        created.alias("carts"),
        half_up(abandoned, created, 4).cast("double").alias("cart_abandonment"),
        half_up(checked_out, created, 4).cast("double").alias("cart_to_order"),
    )
