"""Stored profiles: merging days, verdicts, drift."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.catalog import Table
from tallyhouse.operators.profiles import checks, drift, merged, profile, report

SPEC = Table("things", "id bigint, kind string, amount decimal(12,2), created_at timestamp", unique=(("kind", "id"),))
DDL = "id long, kind string, amount decimal(12,2), created_at timestamp"


@pytest.fixture(scope="module")
def days(spark, tmp_path_factory):
    """Three days of rows, profiled day by day and stored."""
    draw = random.Random(2)
    rows = []
    for day in range(1, 4):
        for n in range(400 if day < 3 else 300):
            rows.append((len(rows) if n % 40 else None, draw.choice("aaabc"), draw.randrange(1000), f"2024-01-0{day} 10:00:00"))
    df = spark.createDataFrame(rows, "id long, kind string, amount int, at string").selectExpr(
        "id", "kind", "cast(amount as decimal(12,2)) amount", "cast(at as timestamp) created_at")
    path = str(tmp_path_factory.mktemp("profiles"))
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        one = df.filter(F.to_date("created_at") == F.lit(day).cast("date"))
        profile(one, "things", F.lit(day).cast("date")).write.mode("append").parquet(path)
    return df, spark.read.parquet(path)


def test_days_merge_to_the_profile_of_all(days):
    df, stored = days
    whole = {r.column_name: r for r in report(merged(stored)).collect()}
    once = {r.column_name: r for r in report(merged(profile(df, "things", F.lit("2024-01-01").cast("date")))).collect()}
    assert set(whole) == set(once) == {"id", "kind", "amount", "created_at"}
    for name in whole:
        assert whole[name][:6] == once[name][:6]
        # Sketches that were merged and a sketch of all rows err by a few per cent, each in its own way.
        assert abs(whole[name].distinct_values - once[name].distinct_values) <= 0.03 * once[name].distinct_values
    assert whole["kind"].distinct_values == 3
    exact = {r.kind: r["count"] for r in df.groupBy("kind").count().collect()}
    assert {r.item: r["count"] for r in whole["kind"].frequent if r.item} == exact
    assert (whole["id"].rows, whole["id"].nulls) == (1100, sum(r.id is None for r in df.collect()))
    middle = sorted(float(r.amount) for r in df.collect())[550]
    assert abs(whole["amount"].quantiles[0] - middle) < 40
    assert whole["kind"].quantiles is None


def test_verdicts_of_a_day(days, rows):
    _, stored = days
    first = {r.rule: (r.passed, r.failed) for r in checks(stored, SPEC, "2024-01-01").collect()}
    assert first == {
        "not_null(id)": (390, 10), "not_null(kind)": (400, 0), "unique(id)": (1, 0), "fresh(created_at)": (1, 0), "row_count": (1, 0),
    }
    third = {r.rule: (r.passed, r.failed) for r in checks(stored, SPEC, "2024-01-03").collect()}
    assert third["row_count"] == (0, 1)
    assert checks(stored, SPEC, "2024-02-01").collect() == []


def test_repeated_keys_and_old_rows_fail(spark):
    df = spark.range(200).selectExpr("id % 100 id", "'x' kind", "cast(1 as decimal(12,2)) amount", "timestamp'2023-12-01 00:00:00' created_at")
    found = {r.rule: (r.passed, r.failed) for r in checks(profile(df, "things", F.lit("2024-01-01").cast("date")), SPEC, "2024-01-01").collect()}
    assert found["unique(id)"] == (0, 1) and found["fresh(created_at)"] == (0, 1)


def test_drift_between_spans(days):
    _, stored = days
    found = {r.column_name: r for r in drift(stored, F.col("ds") <= "2024-01-02", F.col("ds") == "2024-01-03").collect()}
    assert (found["id"].first_rows, found["id"].second_rows) == (800, 300)
    assert abs(found["id"].new_values - 292) < 20 and found["kind"].new_values == 0


def test_empty_table_and_odd_columns(spark):
    empty = spark.createDataFrame([], DDL + ", tags array<string>")
    assert profile(empty, "things", F.lit("2024-01-01").cast("date")).collect() == []
    nothing = spark.createDataFrame([(None, None, None, None)], DDL)
    (row,) = [r for r in report(profile(nothing, "things", F.lit("2024-01-01").cast("date"))).collect() if r.column_name == "amount"]
    assert (row.rows, row.nulls, row.lowest, row.distinct_values, row.quantiles) == (1, 1, None, 0, None)
