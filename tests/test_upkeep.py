"""The sales mart kept up day by day equals the mart built from everything."""

from __future__ import annotations

import random

import pytest

from tallyhouse.plans.marts import build
from tallyhouse.plans.pipeline import load_raw, load_silver, silver_view
from tallyhouse.plans.upkeep import SALES, SALES_TABLES, refresh_sales
from tallyhouse.sources import layer_path, partition_values, read_layer

DAYS = [f"2024-01-0{n}" for n in range(1, 5)]


class Shop:
    """Tables that change at random; every change carries its day."""

    def __init__(self, spark, seed):
        self.spark, self.draw = spark, random.Random(seed)
        self.orders, self.items, self.returns, self.people = {}, {}, {}, {}

    def change(self, day):
        draw, at = self.draw, f"{day} 0{self.draw.randrange(1, 9)}:00:00"
        for n in range(6 if not self.people else 1):
            key = draw.randrange(6) if self.people else n
            self.people[key] = (key, draw.randrange(3), at)
        for _ in range(draw.randrange(2, 6)):
            key = draw.randrange(20)
            when = f"2023-12-{draw.randrange(1, 9):02d} 10:00:00"
            created = self.orders[key][3] if key in self.orders else at
            self.orders[key] = (key, draw.randrange(6), when, created, at, draw.choice(["Completed", "Cancelled", "Pending"]), draw.randrange(100, 900))
        for _ in range(draw.randrange(4)):
            key = len(self.items)
            self.items[key] = (key, draw.randrange(20), draw.randrange(4), draw.randrange(1, 5), at)
        for _ in range(draw.randrange(2)):
            key = draw.randrange(6)
            self.returns[key] = (key, draw.randrange(20), draw.randrange(50), at)

    def sources(self):
        make = self.spark.createDataFrame
        money = "cast({0} as decimal(12,2)) {0}"
        orders = make(list(self.orders.values()), "id long, customer_id long, order_date string, created_at string, updated_at string, status string, total_price int")
        items = make(list(self.items.values()), "id long, order_id long, product_id long, quantity int, created_at string")
        returns = make(list(self.returns.values()), "id long, order_id long, refund_amount int, updated_at string")
        people = make(list(self.people.values()), "id long, geo_location_id long, updated_at string")
        wards = make([(n, f"p{n % 2}") for n in range(3)], "ward_code long, province_name string")
        stamp = "cast({0} as timestamp) {0}"
        return {
            "orders": orders.selectExpr("id", "customer_id", *[stamp.format(c) for c in ("order_date", "created_at", "updated_at")], "status",
                                        money.format("total_price"), "cast(1 as decimal(12,2)) profit", "1L order_channel_id"),
            "order_items": items.selectExpr("id", "order_id", "product_id", "quantity", stamp.format("created_at"), "cast(5 as decimal(12,2)) unit_price",
                                            "cast(1 as decimal(12,2)) discount_amount", "cast(5 as decimal(12,2)) amount"),
            "order_return": returns.selectExpr("id", "order_id", money.format("refund_amount"), stamp.format("updated_at"), "cast(updated_at as timestamp) created_at"),
            "customers": people.selectExpr("id", "geo_location_id", stamp.format("updated_at"), "cast(updated_at as timestamp) created_at"),
            "geo_location": wards,
        }


def load(spark, sources, root, day):
    for name, source in sources.items():
        if load_raw(name, source, root, day):
            load_silver(spark, name, root, day)


def mart_rows(df):
    return sorted(tuple(str(v) for v in row) for row in df.drop("processed_at", "ds").select(*sorted(set(df.columns) - {"processed_at", "ds"})).collect())


@pytest.mark.parametrize("seed", [1])
def test_kept_up_equals_built_whole(spark, tmp_path, seed):
    root, shop, rebuilt = str(tmp_path), Shop(spark, seed), []
    for day in DAYS:
        shop.change(day)
        load(spark, shop.sources(), root, day)
        rebuilt.append(refresh_sales(spark, root, day))
        whole = build(SALES, {name: silver_view(spark, name, root, day) for name in SALES_TABLES}, day)
        assert mart_rows(read_layer(spark, root, "gold", SALES)) == mart_rows(whole), day
    known = partition_values(spark, layer_path(root, "gold", SALES), "order_date")
    assert any(len(days) < len(known) for days in rebuilt[1:])


def test_nothing_new_rebuilds_nothing_and_an_emptied_day_goes(spark, tmp_path):
    root, shop = str(tmp_path), Shop(spark, 9)
    shop.change(DAYS[0])
    shop.orders = {1: (1, 0, "2023-12-01 10:00:00", "2024-01-01 01:00:00", "2024-01-01 01:00:00", "Pending", 5), 2: (2, 0, "2023-12-02 10:00:00", "2024-01-01 01:00:00", "2024-01-01 01:00:00", "Pending", 5)}
    load(spark, shop.sources(), root, DAYS[0])
    assert refresh_sales(spark, root, DAYS[0]) == ["2023-12-01", "2023-12-02"]
    moved = shop.sources()["orders"].filter("id = 2").selectExpr("id", "customer_id", "timestamp'2023-12-01 11:00:00' order_date", "created_at",
        "timestamp'2024-01-02 05:00:00' updated_at", "status", "total_price", "profit", "order_channel_id")
    load(spark, {"orders": moved}, root, DAYS[1])
    assert refresh_sales(spark, root, DAYS[1]) == ["2023-12-01", "2023-12-02"]
    assert partition_values(spark, layer_path(root, "gold", SALES), "order_date") == ["2023-12-01"]
    assert refresh_sales(spark, root, DAYS[2]) == []
