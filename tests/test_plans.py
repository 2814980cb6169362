"""Plan shapes that must hold at any size."""

from __future__ import annotations

import re

import pytest

from parity.queries import QUERIES, callables
from tests.conftest import SMALL
from tallyhouse.plans.marts import build


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"activity_daily_stream", "cart_session_stream"}))
def test_no_cross_products_and_no_python(spark, name):
    plan = plan_of(callables()[name](spark, SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert node not in plan


def test_day_filter_reaches_the_scan(spark):
    plan = plan_of(callables()["incremental_orders"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-05T00:00)" in plan
    assert "LessThan(o_orderdate,1998-01-06T00:00)" in plan


def test_scan_reads_only_used_columns(spark):
    plan = plan_of(callables()["cart_analytics"](spark, SMALL))
    assert "props" not in plan


def test_dedupe_limits_before_the_shuffle(spark):
    plan = plan_of(callables()["silver_order_items"](spark, SMALL))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_sums_combine_before_the_shuffle(spark):
    plan = plan_of(callables()["cart_analytics"](spark, SMALL))
    assert plan.index("Exchange hashpartitioning(channel") < plan.index("partial_sum")


def test_returns_hold_nothing_per_order_and_product(retail):
    plan = build("return_analysis", retail, "2001-08-02")._jdf.queryExecution().optimizedPlan().toString()
    keys = re.findall(r"Aggregate \[([^\]]*)\]", plan)
    assert keys and not [k for k in keys if "order_id" in k and "product_id" in k]
