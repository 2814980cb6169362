"""Marts kept up by what changed: only the groups that a day's rows touch are computed again.

The sales mart has a group for every order day, province and channel and is laid out by order day. A day's load touches some
orders: those that are new or changed, those whose lines, returns or customer changed. The days of these orders, as they
are now and as they were before, are rebuilt from their own orders and replaced; no other partition is written.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans.marts import mart
from tallyhouse.plans.pipeline import silver_view, stamp
from tallyhouse.sinks import Mode, write
from tallyhouse.sources import batch, drop_partition, layer_path, partition_values, read_layer

SALES = "daily_sales_mart"
SALES_TABLES = ("orders", "order_items", "order_return", "customers", "geo_location")


def changed(spark: SparkSession, name: str, root: str, ds: str) -> DataFrame | None:
    """Rows of a silver table that the day brought; None if it brought none."""
    if ds not in partition_values(spark, layer_path(root, "silver", name), "ingestion_date"):
        return None
    return batch(read_layer(spark, root, "silver", name), ds)


def touched_orders(spark: SparkSession, root: str, ds: str, previous: str | None) -> DataFrame:
    """Ids of orders that the day's rows concern, each once.

    A line or a return counts under the order that it belongs to now and under the one that it belonged to before. A change in
    the wards concerns every customer that lives in a changed one.
    """
    found = spark.createDataFrame([], "id bigint")
    for name, column in (("orders", "id"), ("order_items", "order_id"), ("order_return", "order_id")):
        rows = changed(spark, name, root, ds)
        if rows is None:
            continue
        found = found.unionByName(rows.select(F.col(column).cast("bigint").alias("id")))
        if name != "orders" and previous is not None:
            before = silver_view(spark, name, root, previous).join(rows.select("id").distinct(), "id", "left_semi")
            found = found.unionByName(before.select(F.col(column).cast("bigint").alias("id")))
    people = changed(spark, "customers", root, ds)
    owners = spark.createDataFrame([], "customer_id bigint") if people is None else people.select(F.col("id").alias("customer_id"))
    if previous is not None and changed(spark, "geo_location", root, ds) is not None:
        wards = [silver_view(spark, "geo_location", root, day).select("ward_code", "province_name") for day in (previous, ds)]
        moved = wards[0].exceptAll(wards[1]).unionByName(wards[1].exceptAll(wards[0])).select(F.col("ward_code").alias("geo_location_id"))
        living = silver_view(spark, "customers", root, ds).join(moved.distinct(), "geo_location_id", "left_semi")
        owners = owners.unionByName(living.select(F.col("id").alias("customer_id")))
    bought = silver_view(spark, "orders", root, ds).join(owners.distinct(), "customer_id", "left_semi")
    return found.unionByName(bought.select("id")).distinct()


def touched_days(spark: SparkSession, root: str, ds: str, previous: str | None) -> DataFrame:
    """Order days to rebuild: ``order_day``, where the touched orders are now and where they were."""
    orders = touched_orders(spark, root, ds, previous)
    views = [silver_view(spark, "orders", root, day) for day in (ds, previous) if day is not None]
    days = [view.join(orders, "id", "left_semi").select(F.to_date("order_date").alias("order_day")) for view in views]
    both = days[0] if len(days) == 1 else days[0].unionByName(days[1])
    return both.distinct()


def sales_of_days(tables: Mapping[str, DataFrame], days: DataFrame, ds: str) -> DataFrame:
    """The sales mart of some order days: orders of those days, and what hangs on them."""
    orders = tables["orders"].withColumn("order_day", F.to_date("order_date")).join(days, "order_day", "left_semi").drop("order_day")
    ids = orders.select(F.col("id").alias("order_id")).distinct()
    part = dict(tables) | {"orders": orders}
    for name in ("order_items", "order_return"):
        part[name] = tables[name].join(ids, "order_id", "left_semi")
    part.pop("items_per_order", None)
    return mart(SALES).build(part, ds)


def refresh_sales(spark: SparkSession, root: str, ds: str) -> list[str]:
    """Bring the sales mart up to the day; returns the order days that were rebuilt.

    The first time, or when an order has no day, the whole mart is built. A day that lost its last order loses its partition.
    """
    path = layer_path(root, "gold", SALES)
    loaded = sorted({day for name in SALES_TABLES for day in partition_values(spark, layer_path(root, "silver", name), "ingestion_date")})
    earlier = [day for day in loaded if day < ds]
    tables = {name: silver_view(spark, name, root, ds) for name in SALES_TABLES}
    known = partition_values(spark, path, "order_date")
    # One row for each order day, so the list may be looked at.
    days = [row.order_day for row in touched_days(spark, root, ds, earlier[-1] if earlier else None).collect()]
    if not known or not earlier or None in days:
        write(stamp(mart(SALES).build(tables, ds), ds), path, Mode.TABLE, ["order_date"])
        return partition_values(spark, path, "order_date")
    if not days:
        return []
    listed = spark.createDataFrame([(day,) for day in days], "order_day date")
    rebuilt = stamp(sales_of_days(tables, F.broadcast(listed), ds), ds)
    write(rebuilt, path, Mode.PARTITIONS, ["order_date"])
    left = {str(row[0]) for row in tables["orders"].select(F.to_date("order_date")).filter(F.to_date("order_date").isin(days)).distinct().collect()}
    for day in days:
        if str(day) not in left and str(day) in known:
            drop_partition(spark, path, "order_date", str(day))
    return sorted(map(str, days))
