"""Three days of the daily run: incremental facts, versions of customers, quality step, run id."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse.__main__ import main
from tallyhouse.plans.marts.shared import items_per_order
from tallyhouse.plans.pipeline import check_day, load_raw, run_day, silver_view, stored_profiles, versions, with_version
from tallyhouse.sources import layer_path, partition_values, read_layer

DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")


def items(spark, *rows):
    return spark.createDataFrame(rows, "id long, order_id long, product_id long, quantity int, at string").selectExpr(
        "id", "order_id", "product_id", "cast(10 as decimal(12,2)) unit_price", "cast(0 as decimal(12,2)) discount_amount",
        "quantity", "cast(10 * quantity as decimal(12,2)) amount", "true is_active", "cast(at as timestamp) created_at")


def customers(spark, *rows):
    return spark.createDataFrame(rows, "id long, tier string, created string, updated string").selectExpr(
        "id", "'c' || id customer_code", "1L geo_location_id", "tier", "true is_active",
        "cast(created as timestamp) created_at", "cast(updated as timestamp) updated_at")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """The shop's tables as they are on each of three days; the item fact has a history before the first."""
    root = str(tmp_path_factory.mktemp("lake"))
    history = [(n, n // 2, n % 3, 1 + n % 4, "2023-12-0%d 10:00:00" % (1 + n % 9)) for n in range(40)]
    second = [(100, 50, 1, 2, "2024-01-02 08:00:00"), (101, 50, 2, 1, "2024-01-02 08:00:00")]
    third = [(102, 51, 1, 4, "2024-01-03 09:00:00"), (None, 51, 1, 4, "2024-01-03 09:00:00")]
    people = [
        [(1, "Bronze", "2024-01-01 01:00:00", None), (2, "Gold", "2024-01-01 01:00:00", None)],
        [(1, "Silver", "2024-01-01 01:00:00", "2024-01-02 05:00:00"), (2, "Gold", "2024-01-01 01:00:00", None)],
        [(1, "Silver", "2024-01-01 01:00:00", "2024-01-02 05:00:00"), (2, "Platinum", "2024-01-01 01:00:00", "2024-01-03 05:00:00"),
         (3, "Bronze", "2024-01-03 06:00:00", None)],
    ]
    facts = [history, history + second, history + second + third]
    for day, own, lines in zip(DAYS, people, facts):
        run_day(spark, {"customers": customers(spark, *own), "order_items": items(spark, *lines)}, root, day, marts=(), run_id=f"run-{day}", version="7")
    return root


def test_the_first_load_takes_the_history_and_later_ones_the_day(spark, lake):
    raw = {r.ingestion_date: r["count"] for r in read_layer(spark, lake, "raw", "order_items").groupBy(F.col("ingestion_date").cast("string").alias("ingestion_date")).count().collect()}
    assert raw == dict(zip(DAYS, (40, 2, 2)))
    assert silver_view(spark, "order_items", lake).count() == 43
    assert silver_view(spark, "order_items", lake, DAYS[0]).count() == 40


def test_sums_equal_a_full_copy(spark, lake, rows):
    whole = silver_view(spark, "order_items", lake)
    per_order = items_per_order(whole).filter("order_id >= 50")
    assert rows(per_order, "order_id", "items_sold") == [(50, 3), (51, 4)]


def test_a_first_day_loaded_again_stays_whole(spark, tmp_path):
    lines = items(spark, (1, 1, 1, 1, "2023-12-01 10:00:00"), (2, 1, 2, 1, "2024-01-01 10:00:00"))
    for _ in range(2):
        assert load_raw("order_items", lines, str(tmp_path), DAYS[0])
    assert read_layer(spark, str(tmp_path), "raw", "order_items").count() == 2
    assert not load_raw("order_items", lines, str(tmp_path), "2024-02-01")


def test_customers_keep_their_versions(spark, lake):
    found = sorted((r.id, r.tier, str(r.valid_from), str(r.valid_to), r.is_current) for r in versions(spark, "customers", lake).collect())
    assert found == [
        (1, "Bronze", "2024-01-01", "2024-01-02", False), (1, "Silver", "2024-01-02", "None", True),
        (2, "Gold", "2024-01-01", "2024-01-03", False), (2, "Platinum", "2024-01-03", "None", True),
        (3, "Bronze", "2024-01-03", "None", True),
    ]
    then = sorted((r.id, r.tier) for r in versions(spark, "customers", lake, DAYS[1]).filter("is_current").collect())
    assert then == [(1, "Silver"), (2, "Gold")]
    assert versions(spark, "customers", lake, "2023-01-01") is None


def test_facts_meet_the_version_of_their_moment(spark, lake):
    orders = spark.createDataFrame(
        [(1, 1, "2023-12-31"), (2, 1, "2024-01-01"), (3, 1, "2024-01-02"), (4, 2, "2024-01-02"), (5, 2, "2024-01-09"), (6, 9, "2024-01-09"), (7, None, "2024-01-09"), (8, 1, None)],
        "id long, customer_id long, day string",
    ).selectExpr("id", "customer_id", "cast(day as timestamp) order_date")
    found = with_version(orders, versions(spark, "customers", lake), "customer_id", "id", "order_date", ["tier"])
    assert {r.id: r.tier_then for r in found.collect()} == {1: None, 2: "Bronze", 3: "Silver", 4: "Gold", 5: "Platinum", 6: None, 7: None, 8: None}


def test_a_closed_version_ends(spark):
    history = spark.createDataFrame([(1, "a", "2024-01-01", "2024-01-05")], "id long, tier string, f string, t string").selectExpr(
        "id", "tier", "cast(f as date) valid_from", "cast(t as date) valid_to")
    facts = spark.createDataFrame([(1, 1, "2024-01-04"), (2, 1, "2024-01-05")], "id long, customer_id long, d string").selectExpr(
        "id", "customer_id", "cast(d as timestamp) at")
    found = with_version(facts, history, "customer_id", "id", "at", ["tier"])
    assert {r.id: r.tier_then for r in found.collect()} == {1: "a", 2: None}


def test_the_day_is_judged(spark, lake):
    assert partition_values(spark, layer_path(lake, "quality", "checks"), "ds") == list(DAYS)
    found = {(r.table_name, r.rule): (r.passed, r.failed) for r in check_day(spark, lake, DAYS[2]).collect()}
    assert found[("order_items", "null_id")] == (0, 1)
    assert found[("order_items", "not_null(id)")] == (1, 0)
    assert found[("order_items", "row_count")] == (0, 1)
    assert found[("customers", "unique(id)")] == (1, 0)
    assert stored_profiles(spark, "order_items", lake).select("ds").distinct().count() == 3
    assert stored_profiles(spark, "orders", lake) is None


def test_lineage_reaches_silver(spark, lake):
    stamps = read_layer(spark, lake, "silver", "order_items").select("_pipeline_run_id", "_data_version").distinct().collect()
    assert {tuple(r) for r in stamps} == {(f"run-{day}", "7") for day in DAYS} or {r[0] for r in stamps} == {f"run-{day}" for day in DAYS}


def test_command_line_checks_and_refuses(spark, lake, tmp_path, capsys):
    main(["check", "--lake", lake, "--ds", DAYS[2]])
    assert "order_items null_id: 1 failed" in capsys.readouterr().out
    export = str(tmp_path / "export")
    spark.createDataFrame([(1, "x")], "id long, name string").write.parquet(export)
    with pytest.raises(ValueError, match="missing created_at"):
        main(["ingest", "--table", "brand", "--from", export, "--lake", str(tmp_path / "lake"), "--ds", DAYS[0], "--strict"])
    main(["ingest", "--table", "brand", "--from", export, "--lake", str(tmp_path / "lake"), "--ds", DAYS[0]])
    main(["clean", "--table", "brand", "--lake", str(tmp_path / "lake"), "--ds", DAYS[0], "--run-id", "r1", "--data-version", "v1"])
    row = read_layer(spark, str(tmp_path / "lake"), "silver", "brand").first()
    assert (row._pipeline_run_id, row._data_version) == ("r1", "v1")
