"""Stock that lines use up, against a plain loop; hot products against ordinary ones."""

from __future__ import annotations

import random

import pytest

from tallyhouse.operators.allocation import allocate_in_turn, remaining_stock

LINES = "id long, product_id long, quantity int, created_at timestamp"
STOCK = "id long, product_id long, warehouse_id long, quantity int"


def loop(lines, stock):
    left = {}
    for number, product, house, quantity in stock:
        if quantity is not None and product is not None:
            left.setdefault(product, {})[number] = [quantity, house]
    found = {}
    for number, product, quantity, _ in sorted(lines, key=lambda r: (r[3], r[0])):
        houses = left.get(product, {}) if product is not None else {}
        total = sum(q for q, _ in houses.values()) if houses else None
        top = max(houses, key=lambda n: (houses[n][0], -n)) if houses else None
        if top is not None and quantity is not None and houses[top][0] >= quantity:
            found[number] = (top, houses[top][1], None)
            houses[top][0] -= max(quantity, 0)
        elif total is None or (quantity is not None and total < quantity):
            found[number] = (None, None, "insufficient_stock")
        else:
            found[number] = (None, None, "no_single_warehouse")
    return found, {n: q for houses in left.values() for n, (q, _) in houses.items()}


def tables(spark, seed, most=40):
    draw = random.Random(seed)
    stock = [(n, draw.choice([1, 1, 2, 3, None]), draw.randrange(5), draw.choice([None, 0, 3, 9, 9, 60])) for n in range(20)]
    lines = [
        (n, draw.choice([1, 1, 1, 1, 2, 3, 4, None]), draw.choice([None, 0, -2, 1, 1, 2, 3, 5, 8, most]), draw.randrange(100))
        for n in range(400)
    ]
    df = spark.createDataFrame([(a, b, c, None) for a, b, c, _ in lines], LINES).drop("created_at")
    moments = spark.createDataFrame([(a, d) for a, _, _, d in lines], "id long, t long")
    df = df.join(moments, "id").selectExpr("id", "product_id", "quantity", "timestamp_seconds(t) created_at")
    return lines, stock, df, spark.createDataFrame(stock, STOCK)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot_rows", [10_000, 60], ids=["plain", "hot"])
def test_lines_take_stock_like_a_loop(spark, seed, hot_rows):
    lines, stock, items, inventory = tables(spark, seed)
    taken = allocate_in_turn(items, inventory, hot_rows=hot_rows, slice_rows=17)
    expected, left = loop(lines, stock)
    found = taken.collect()
    assert len(found) == len(lines)
    assert {r.id: (r.inventory_id, r.allocated_warehouse_id, r.reject_reason) for r in found} == expected
    after = remaining_stock(items, inventory, taken).filter("quantity is not null and product_id is not null").collect()
    assert {r.id: r.quantity for r in after} == left
    assert taken.columns == [*items.columns, "inventory_id", "allocated_warehouse_id", "reject_reason"]


def test_more_lines_than_one_part_of_the_fold(spark):
    items = spark.range(1, 1501).selectExpr("id", "1L product_id", "cast(1 + id % 3 as int) quantity", "timestamp_seconds(id) created_at")
    inventory = spark.createDataFrame([(n, 1, n, 130 * n) for n in range(1, 6)], STOCK)
    expected, _ = loop([(r.id, r.product_id, r.quantity, r.created_at) for r in items.collect()], [tuple(r) for r in inventory.collect()])
    found = {r.id: (r.inventory_id, r.allocated_warehouse_id, r.reject_reason) for r in allocate_in_turn(items, inventory).collect()}
    assert found == expected
    assert sum(v[0] is not None for v in found.values()) > 600


def test_empty_tables(spark):
    items, inventory = spark.createDataFrame([], LINES), spark.createDataFrame([], STOCK)
    assert allocate_in_turn(items, inventory).collect() == []
    one = spark.createDataFrame([(1, 1, 2)], "id long, product_id long, quantity int").selectExpr("*", "timestamp_seconds(0) created_at")
    assert [r.reject_reason for r in allocate_in_turn(one, inventory).collect()] == ["insufficient_stock"]
