from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import constraints, quality
from tallyhouse.operators.validation import Rule, accepted, pass_rates, quarantined, validate

def rules():
    return [Rule("positive", F.col("v") > 0), Rule("small", F.col("v") < 10)]


def frame(spark):
    return spark.createDataFrame([(1, 5), (2, -1), (3, 50), (4, None), (None, 1)], "id long, v int")


def test_good_and_bad_make_up_the_input(spark, rows):
    judged = validate(frame(spark), rules())
    good, bad = accepted(judged), quarantined(judged)
    assert rows(good, "id") == [(1,), (4,), (None,)]
    assert rows(bad, "id", "reject_reason") == [(2, "positive"), (3, "small")]
    assert "rejected_at" in bad.columns and good.columns == ["id", "v"]


def test_several_reasons_are_listed_in_order(spark):
    rules = [Rule("a", F.lit(False)), Rule("b", F.lit(True)), Rule("c", F.lit(False))]
    assert validate(spark.range(1), rules).first().reject_reason == "a,c"


def test_pass_rates(spark, rows):
    assert rows(pass_rates(frame(spark), "t", "d", rules())) == [("t", "positive", "d", 4, 1), ("t", "small", "d", 4, 1)]


def test_not_null_unique(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id long")
    result = quality.not_null_unique(df, "t", "d", ["id"])
    assert rows(result, "rule", "passed", "failed") == [("not_null(id)", 3, 1), ("unique(id)", 2, 2)]


def test_freshness_boundary(spark, rows):
    df = spark.createDataFrame([("2024-01-13 00:00:00",), ("2024-01-12 23:59:59",), (None,)], "t string").selectExpr(
        "cast(t as timestamp) created_at"
    )
    assert rows(quality.freshness(df, "t", "2024-01-15"), "passed", "failed") == [(1, 2)]


def test_row_count_drift(spark, rows):
    def verdict(source, target):
        return quality.row_count_drift(spark.range(source), spark.range(target), "t", "d").first().within_tolerance

    assert verdict(100, 96) and not verdict(100, 95) and not verdict(0, 0) and verdict(100, 104)


def test_schema_differences():
    expected = T.StructType.fromDDL("id bigint, name string, price decimal(12,2)")
    actual = T.StructType.fromDDL("id int, price decimal(12,2), extra string")
    assert quality.schema_differences(actual, expected) == [
        "missing name", "unexpected extra", "id is int, expected bigint"]
    assert quality.schema_differences(expected, expected) == []


def test_order_totals(spark, rows):
    placed = spark.createDataFrame([(1, 3), (2, 4), (3, -1), (4, 0)], "id long, t int").selectExpr(
        "id", "cast(t as decimal(18,2)) total_price")
    items = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "order_id long, a int").selectExpr(
        "order_id", "cast(a as decimal(12,2)) amount")
    assert rows(quality.judge_order_totals(placed, items), "id", "reject_reason") == [
        (1, None), (2, "total_differs_from_items"), (3, "total_negative,total_differs_from_items"), (4, None)]


def test_constraint_checks(spark, rows):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1, "a"), (1, "a"), (9, "z"), (None, None)], "ref long, kind string")
    assert constraints.check_reference(child, "t", "ref", parent, "id").first()[2:] == (3, 1)
    assert constraints.check_unique(child, "t", ["ref"]).first()[2:] == (3, 1)
    rules = [constraints.domain("kind", ["a"]), constraints.not_null("ref"), constraints.at_least("ref", 2)]
    assert rows(constraints.check_rows(child, "t", rules)) == [
        ("t", "at_least(ref,2)", 3, 2), ("t", "domain(kind)", 3, 1), ("t", "not_null(ref)", 4, 1)]
    empty = child.filter("ref = 77")
    assert constraints.check_reference(empty, "t", "ref", parent, "id").first()[2:] == (0, 0)


def test_declared_constraints_of_a_table(spark):
    cart = spark.createDataFrame([(1, 1, "active", None), (1, 5, "odd", 3)], "id long, customer_id long, status string, order_id long")
    customers = spark.createDataFrame([(1,)], "id long")
    found = {row.rule: row.failed for row in constraints.check_table({"cart": cart, "customers": customers}, "cart").collect()}
    assert found == {"unique(id)": 1, "reference(customer_id)": 1, "domain(status)": 1}


def test_constraint_keys_of_whole_numbers_stay_numbers(spark, rows):
    columns = "customer_id long, product_id int, order_id string"
    wishlist = spark.createDataFrame([(1, 12, None), (11, 2, None), (1, 12, None), (None, 2, None), (1, None, None)], columns)
    cart = spark.createDataFrame([(1, None, "7"), (2, None, "07")], columns).withColumn("id", F.lit(5).cast("smallint"))
    tables = {
        "wishlist": wishlist,
        "cart": cart,
        "customers": spark.createDataFrame([(1,), (3,)], "id int"),
        "orders": spark.createDataFrame([(7,)], "id long"),
    }
    made = constraints.check_all(tables, ["wishlist", "cart"])
    assert rows(made, "table_name", "rule", "checked", "failed") == [
        ("cart", "reference(customer_id)", 2, 1), ("cart", "reference(order_id)", 2, 1), ("cart", "unique(id)", 2, 1),
        ("wishlist", "reference(customer_id)", 4, 1), ("wishlist", "unique(customer_id,product_id)", 3, 1)]
    numbers = constraints.check_all({"customers": tables["customers"]}, ["customers"])
    plan = numbers._jdf.queryExecution().optimizedPlan().toString()
    assert "as string)" not in plan and "lambda" not in plan
