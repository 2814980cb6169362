"""History jobs against a row-by-row fold, on ordinary and on hot keys."""

from __future__ import annotations

import random

import random

import pytest

from tallyhouse.operators.sequence import (
    asof_join,
    clamped_balance,
    dense_sequence,
    last_value,
    previous_value,
    running_total,
    split_hot,
)


@pytest.fixture(scope="module")
def history(spark):
    """One key holds most of the rows; some keys and values are NULL."""
    rng = random.Random(7)
    data = []
    for number in range(600):
        key = 1 if rng.random() < 0.6 else rng.choice([2, 3, 4, None])
        data.append((key, rng.randrange(40), number, rng.randrange(-9, 8), rng.choice(["a", "b", None])))
    df = spark.createDataFrame(data, "k long, t long, id long, change int, status string")
    df = df.selectExpr("k", "timestamp_seconds(t * 40000) t", "id", "change", "status", "5 opening").cache()
    by_key: dict = {}
    for row in sorted(df.collect(), key=lambda row: (row.t, row.id)):
        by_key.setdefault(row.k, []).append(row)
    return df, by_key


BOTH = pytest.mark.parametrize("hot_rows", [10_000, 50], ids=["plain", "hot"])


def test_hot_keys_are_split_off(history):
    df, by_key = history
    ordinary, hot = split_hot(df, ["k"], 200)
    assert {row.k for row in hot.select("k").distinct().collect()} == {1}
    assert ordinary.count() + hot.count() == df.count()
    assert split_hot(df, ["k"], 10_000)[1] is None


@BOTH
def test_previous_value(history, hot_rows):
    df, by_key = history
    result = previous_value(df, ["k"], ["t", "id"], "status", "before", hot_rows)
    expected = {}
    for rows in by_key.values():
        last = None
        for row in rows:
            expected[row.id] = last
            last = row.status
    assert {row.id: row.before for row in result.collect()} == expected


@BOTH
def test_running_total(history, hot_rows):
    df, by_key = history
    result = running_total(df, ["k"], ["t", "id"], "change", "total", hot_rows)
    expected = {}
    for rows in by_key.values():
        total = 0
        for row in rows:
            total += row.change
            expected[row.id] = total
    assert {row.id: row.total for row in result.collect()} == expected


@BOTH
def test_clamped_balance(history, hot_rows):
    df, by_key = history
    result = clamped_balance(df, ["k"], ["t", "id"], "change", "opening", hot_rows)
    expected = {}
    for rows in by_key.values():
        balance = 5
        for row in rows:
            after = max(0, balance + row.change)
            expected[row.id] = (balance, after, after - balance)
            balance = after
    got = {row.id: (row.quantity_before, row.quantity_after, row.applied_change) for row in result.collect()}
    assert got == expected


def test_dense_sequence_crosses_slices(spark):
    ids = [3, 16_383, 16_384, 16_385, 40_000, 2**26 - 1, 2**26, 2**26 + 5, 2**27]
    data = [(value, group) for value in ids for group in ("x",)] + [(9, None), (70_000, None)]
    df = spark.createDataFrame(data, "id long, g string")
    result = {(row.g, row.id): row.n for row in dense_sequence(df, "id", "n", ["g"]).collect()}
    assert [result[("x", value)] for value in ids] == list(range(1, len(ids) + 1))
    assert (result[(None, 9)], result[(None, 70_000)]) == (1, 2)


def test_dense_sequence_without_groups(spark):
    df = spark.range(0, 200_000, 7)
    numbered = dense_sequence(df, "id", "n")
    assert numbered.filter("n <> id / 7 + 1").count() == 0
    assert numbered.count() == df.count()


@pytest.mark.parametrize("seed", range(3))
def test_slices_equal_one_window_with_nulls_and_ties(spark, rows, seed):
    """Mostly NULL values, so that slices begin with them; times tie and ids decide."""
    draw = random.Random(seed)
    data = [
        (k, draw.randrange(9), n, draw.choice([None, None, None, -6, -1, 2, 5]), 3)
        for n, k in enumerate(draw.choice([1, 1, 1, 2, None]) for _ in range(160))
    ]
    df = spark.createDataFrame(data, "k int, t int, id int, v int, opening int").repartition(5)
    for job in (
        lambda hot: running_total(df, ["k"], ["t", "id"], "v", "out", hot),
        lambda hot: previous_value(df, ["k"], ["t", "id"], "v", "out", hot),
        lambda hot: clamped_balance(df, ["k"], ["t", "id"], "v", "opening", hot),
    ):
        assert rows(job(5)) == rows(job(10_000))


def wild_ids(draw, kind):
    if kind == "sparse":
        return [draw.randrange(-(2**62), 2**62) for _ in range(300)]
    if kind == "clumps":
        return [base + k for base in (-(2**40), 0, 2**61) for k in range(100)]
    return list(range(-150, 150))


@pytest.mark.parametrize("kind", ["sparse", "clumps", "dense"])
@pytest.mark.parametrize("groups", [[], ["g"], ["g", "h"]], ids=["none", "one", "two"])
def test_numbers_follow_the_rank_whatever_the_ids(spark, kind, groups):
    draw = random.Random(4)
    data = [(value, draw.choice(["x", "x", "x", "y", None]), draw.randrange(2)) for value in set(wild_ids(draw, kind))]
    df = spark.createDataFrame(data, "id long, g string, h int").repartition(7)
    numbered = dense_sequence(df, "id", "n", groups)
    assert numbered.columns == ["id", "g", "h", "n"]
    expected, seen = {}, {}
    for row in sorted(data):
        group = tuple({"g": row[1], "h": row[2]}[name] for name in groups)
        seen[group] = seen.get(group, 0) + 1
        expected[row[0]] = seen[group]
    assert {row.id: row.n for row in numbered.collect()} == expected


def exchanges(df):
    return df._jdf.queryExecution().explainString(spark_mode(df)).count("Exchange ")


def spark_mode(df):
    return df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")


def test_numbering_plans_few_exchanges(spark):
    df = spark.range(100).selectExpr("id", "id % 3 g")
    assert exchanges(dense_sequence(df, "id", "n")) <= 3
    assert exchanges(dense_sequence(df, "id", "n", ["g"])) <= 4


@BOTH
def test_last_value(history, hot_rows):
    df, by_key = history
    result = last_value(df, ["k"], ["t", "id"], "status", "known", hot_rows)
    expected = {}
    for rows in by_key.values():
        last = None
        for row in rows:
            last = row.status if row.status is not None else last
            expected[row.id] = last
    assert {row.id: row.known for row in result.collect()} == expected


def test_last_value_without_keys(history):
    df, _ = history
    expected, last = {}, None
    for row in sorted(df.collect(), key=lambda row: (row.t, row.id)):
        last = row.status if row.status is not None else last
        expected[row.id] = last
    assert {row.id: row.known for row in last_value(df, [], ["t", "id"], "status", "known").collect()} == expected


@pytest.mark.parametrize("hot_rows", [10_000, 30], ids=["plain", "hot"])
@pytest.mark.parametrize("keys", [["k"], []], ids=["keyed", "keyless"])
def test_asof_join_finds_the_last_version_begun(spark, keys, hot_rows):
    draw = random.Random(11)
    facts = [(n, draw.choice([1, 1, 1, 2, 3, None]), draw.choice([None, *range(30)])) for n in range(300)]
    versions = {(draw.choice([1, 2, None]) if keys else 0, draw.choice([None, *range(30)])): n for n in range(25)}
    left = spark.createDataFrame(facts, "id long, k long, t long")
    right = spark.createDataFrame([(k, t, f"v{n}", n if n % 3 else None) for (k, t), n in versions.items()], "k long, since int, name string, w int")
    found = asof_join(left, right, keys, "t", "since", ["name", "w"], hot_rows)
    assert found.columns == ["id", "k", "t", "name", "w"]
    expected = {}
    for number, k, t in facts:
        begun = [(s, n) for (key, s), n in versions.items() if s is not None and t is not None and s <= t and (not keys or (key == k and k is not None))]
        n = max(begun)[1] if begun else None
        expected[number] = (None, None) if n is None else (f"v{n}", n if n % 3 else None)
    assert {r.id: (r.name, r.w) for r in found.collect()} == expected


def test_asof_join_of_empty_tables(spark):
    left = spark.createDataFrame([], "id long, k long, t long")
    right = spark.createDataFrame([], "k long, since long, name string")
    assert asof_join(left, right, ["k"], "t", "since", ["name"]).collect() == []
    one = spark.createDataFrame([(1, 1, 5)], "id long, k long, t long")
    assert [tuple(r) for r in asof_join(one, right, ["k"], "t", "since", ["name"]).collect()] == [(1, 1, 5, None)]
