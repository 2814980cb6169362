"""Discounts in force, against every pair of order and discount."""

from __future__ import annotations

import random

import pytest

from tallyhouse.operators.promotions import discount_timeline, discounts_in_force

ORDERS = "id long, t long"
DISCOUNTS = "id long, value int, s long, e long, is_active boolean"


def tables(spark, orders, discounts):
    left = spark.createDataFrame(orders, ORDERS).selectExpr("id", "timestamp_micros(t) order_date")
    right = spark.createDataFrame(discounts, DISCOUNTS).selectExpr(
        "id", "value", "timestamp_micros(s) start_date", "timestamp_micros(e) end_date", "is_active")
    return left, right


def pairs(orders, discounts):
    found = {}
    for number, t in orders:
        here = [d for d in discounts if d[4] and t is not None and d[2] is not None and d[3] is not None and d[2] <= t <= d[3]]
        best = max(here, key=lambda d: (d[1], -d[0])) if here else None
        found[number] = (len(here), best and best[0], best and best[1])
    return found


@pytest.mark.parametrize("reach", [12, 10**15], ids=["near", "far"])
@pytest.mark.parametrize("seed", range(2))
def test_orders_meet_the_discounts_of_their_moment(spark, reach, seed):
    draw = random.Random(seed)
    discounts = [
        (n, draw.randrange(5), draw.randrange(-reach, reach), draw.choice([None, draw.randrange(-reach, reach), reach]), draw.random() < 0.9)
        for n in range(60)
    ]
    ends = [d[2] for d in discounts] + [d[3] for d in discounts if d[3] is not None]
    moments = [None, *ends, *[e + 1 for e in ends], *[e - 1 for e in ends], *[draw.randrange(-reach, reach) for _ in range(100)]]
    orders = list(enumerate(moments))
    left, right = tables(spark, orders, discounts)
    found = discounts_in_force(left, right).collect()
    assert len(found) == len(orders)
    assert {r.order_id: (r.discounts, r.best_discount_id, r.best_value) for r in found} == pairs(orders, discounts)


def test_empty_tables_and_open_ends(spark):
    left, right = tables(spark, [(1, 5)], [(1, 3, 0, 9 * 10**16, True)])
    assert [tuple(r) for r in discounts_in_force(left, right).collect()] == [(1, 1, 1, 3)]
    assert discounts_in_force(left.limit(0), right).collect() == []
    assert [tuple(r) for r in discounts_in_force(left, right.limit(0)).collect()] == [(1, 0, None, None)]
    assert discount_timeline(right.limit(0)).collect() == []
    # A discount of centuries is two moments and a short list of spans.
    assert discount_timeline(right).count() == 2
