from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.skew import absent_from, hot_keys, present_in, salted_join


@pytest.fixture(scope="module")
def sides(spark):
    fact = spark.createDataFrame([(1 if n % 3 else n, n) for n in range(300)], "k long, v long")
    keyed = spark.createDataFrame([(k, f"n{k}") for k in range(0, 200, 2)] + [(1, "one")], "k long, name string")
    return fact, keyed


@pytest.mark.parametrize("hot_rows", [10, 1000], ids=["hot", "none hot"])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_join(sides, rows, how, hot_rows):
    fact, keyed = sides
    joined = salted_join(fact, keyed, "k", how, hot_rows=hot_rows)
    assert rows(joined) == rows(fact.join(keyed, "k", how))


def test_only_hot_keys_are_listed(sides, rows):
    fact, _ = sides
    assert rows(hot_keys(fact, ["k"], 10)) == [(1,)]
    assert hot_keys(fact, ["k"], 1000).count() == 0


def test_null_and_composite_keys(spark, rows):
    fact = spark.createDataFrame([(1, "a", n) for n in range(50)] + [(None, "a", 1), (2, None, 2)], "k long, s string, v int")
    keyed = spark.createDataFrame([(1, "a", "x"), (None, "a", "y"), (2, None, "z")], "k long, s string, name string")
    joined = salted_join(fact, keyed, ["k", "s"], hot_rows=10)
    assert rows(joined) == rows(fact.join(keyed, ["k", "s"], "left"))


def test_a_hot_key_reaches_many_tasks(sides):
    fact, keyed = sides
    spark = fact.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(fact.filter("k = 1"), keyed, "k", hot_rows=10)
        spread = joined.groupBy(F.spark_partition_id().alias("task")).count()
        assert spread.count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_salted_join_refuses_to_keep_the_repeated_side(sides):
    with pytest.raises(ValueError):
        salted_join(*sides, "k", "full")


def test_absent_and_present_split_the_left_side(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    right = spark.createDataFrame([(1,), (1,), (None,)], "ref long")
    assert rows(absent_from(left, right, {"id": "ref"})) == [(2,), (None,)]
    assert rows(present_in(left, right, {"id": "ref"})) == [(1,)]


@pytest.mark.parametrize("how, kept", [("left", 300), ("left_anti", 300), ("inner", 0), ("left_semi", 0)])
def test_rows_without_a_key_reach_many_tasks(spark, sides, how, kept):
    _, keyed = sides
    fact = spark.range(300).selectExpr("cast(null as long) k", "id v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(fact, keyed, "k", how)
        tasks = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(row["count"] for row in tasks) == kept
    assert not kept or len(tasks) > 1


@pytest.mark.parametrize("kinds", [("int", "long"), ("long", "int"), ("long", "decimal(12,2)"), ("string", "long")])
@pytest.mark.parametrize("how", ["inner", "left_anti"])
def test_keys_of_different_types_meet(spark, rows, kinds, how):
    fact = spark.createDataFrame([(5 if n % 4 else n, n) for n in range(200)], "k long, v long").selectExpr(f"cast(k as {kinds[0]}) k", "v")
    keyed = spark.range(0, 150, 2).unionByName(spark.createDataFrame([(5,)], "id long")).selectExpr(f"cast(id as {kinds[1]}) k", "id w")
    plain = fact.join(keyed.withColumnRenamed("k", "o"), fact["k"] == F.col("o"), how)
    expected = rows(plain.select("v", "w") if how == "inner" else plain.select("v"))
    joined = salted_join(fact, keyed, "k", how, hot_rows=10)
    assert rows(joined.select("v", "w") if how == "inner" else joined.select("v")) == expected
