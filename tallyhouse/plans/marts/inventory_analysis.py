"""Stock health per stock row: turnover, dead stock, losses, days left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import count_where, half_up, money, or_zero, sum_where
from tallyhouse.plans.marts.shared import Tables, day, product_tree, warehouse_places

# Fixed value: days without movement after which stock counts as dead.
DEAD_AFTER_DAYS = 30


def log_metrics(log: DataFrame) -> DataFrame:
    """Movement totals, event counts and first and last day per stock row."""

    def kind(name: str) -> Column:
        return F.col("change_type") == name

    change = F.col("quantity_change").cast("bigint")
    moved = F.to_date("created_at")
    return log.groupBy("inventory_id").agg(
        sum_where(kind("sale"), F.abs(change)).alias("total_sold_qty"),
        sum_where(kind("restock"), change).alias("total_restock_qty"),
        sum_where(kind("return"), change).alias("total_return_qty"),
        sum_where(kind("adjustment"), change).alias("total_adjustment_qty"),
        sum_where(kind("damage"), F.abs(change)).alias("total_damage_qty"),
        count_where(kind("sale")).alias("sale_event_count"),
        count_where(kind("restock")).alias("restock_event_count"),
        count_where(kind("damage")).alias("damage_event_count"),
        F.count(F.lit(1)).alias("total_log_events"),
        F.max(moved).alias("last_movement_date"),
        F.min(moved).alias("first_movement_date"),
    )


def inventory_analysis(tables: Tables, as_of: str) -> DataFrame:
    """One row per stock row on the day ``as_of``."""
    metrics = log_metrics(tables["inventory_log"])
    totals = [name for name in metrics.columns if name.endswith(("_qty", "_count", "_events"))]
    stock = (
        tables["inventory"]
        .withColumnRenamed("id", "inventory_id")
        .join(metrics, "inventory_id", "left")
        .withColumns({name: or_zero(name) for name in totals})
        .join(product_tree(tables, F.col("price").alias("product_price")), "product_id", "left")
        .join(warehouse_places(tables), "warehouse_id", "left")
    )
    quantity, safety = F.col("quantity"), F.col("safety_stock")
    sold, damaged = F.col("total_sold_qty"), F.col("total_damage_qty")
    idle = F.datediff(day(as_of), "last_movement_date")
    span = F.datediff("last_movement_date", "first_movement_date")
    handled = sold + quantity
    return stock.select(
        "inventory_id",
        "product_id",
        "product_name",
        "category_name",
        "sub_category_name",
        "product_price",
        "warehouse_id",
        "warehouse_name",
        "province_name",
        quantity.alias("current_quantity"),
        "safety_stock",
        "reorder_level",
        "unit_cost",
        money(quantity * F.col("unit_cost")).alias("stock_value"),
        (quantity <= F.col("reorder_level")).alias("is_low_stock"),
        (quantity <= safety).alias("is_critical_stock"),
        (quantity == 0).alias("is_out_of_stock"),
        F.when(safety > 0, half_up(quantity - safety, safety, 2)).cast("double").alias("stock_buffer_ratio"),
        *totals,
        "last_movement_date",
        "first_movement_date",
        idle.alias("days_since_last_movement"),
        ((quantity > 0) & ((idle > DEAD_AFTER_DAYS) | idle.isNull())).alias("is_dead_stock"),
        F.when(quantity > 0, half_up(sold, quantity, 2)).otherwise(0).cast("double").alias("turnover_rate"),
        F.when(handled > 0, half_up(damaged * 100, handled, 2))
        .otherwise(0)
        .cast("double")
        .alias("damage_loss_rate"),
        F.when((sold > 0) & (span > 0), half_up(quantity.cast("bigint") * span, sold, 1))
        .cast("double")
        .alias("days_of_stock_remaining"),
        day(as_of).alias("snapshot_date"),
    )
