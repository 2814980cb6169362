"""The gold marts: ``build(tables, as_of) -> DataFrame``, looked up by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyhouse.plans.marts.cart_analytics import cart_analytics
from tallyhouse.plans.marts.customer_analytics import customer_analytics
from tallyhouse.plans.marts.customer_retention import customer_retention
from tallyhouse.plans.marts.daily_sales import daily_sales
from tallyhouse.plans.marts.inventory_analysis import inventory_analysis
from tallyhouse.plans.marts.inventory_snapshot import inventory_snapshot
from tallyhouse.plans.marts.logistics import logistics
from tallyhouse.plans.marts.product_performance import product_performance
from tallyhouse.plans.marts.return_analysis import return_analysis
from tallyhouse.sinks import Mode


@dataclass(frozen=True)
class Mart:
    """A mart builder and how its table is laid out and replaced.

    Marts that describe the state of the day are replaced as a whole,
    because their rows move between partitions from run to run. Snapshots
    keep one partition per day.
    """

    build: Callable[..., DataFrame]
    partition_by: str
    mode: Mode = Mode.TABLE


MARTS: dict[str, Mart] = {
    "daily_sales_mart": Mart(daily_sales, "order_date"),
    "customer_analytics_mart": Mart(customer_analytics, "tier"),
    "product_performance_mart": Mart(product_performance, "category_name"),
    "logistics_mart": Mart(logistics, "logistics_partner_name"),
    "inventory_snapshot_mart": Mart(inventory_snapshot, "snapshot_date", Mode.PARTITIONS),
    "cart_analytics_mart": Mart(cart_analytics, "channel"),
    "inventory_analysis": Mart(inventory_analysis, "snapshot_date", Mode.PARTITIONS),
    "customer_retention": Mart(customer_retention, "churn_segment"),
    "return_analysis": Mart(return_analysis, "category_name"),
}


def mart(name: str) -> Mart:
    if name not in MARTS:
        raise KeyError(f"unknown mart {name!r}; known: {', '.join(MARTS)}")
    return MARTS[name]


def build(name: str, tables: Mapping[str, DataFrame], as_of: str) -> DataFrame:
    return mart(name).build(tables, as_of)
