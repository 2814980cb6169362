from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.catalog import INCREMENTAL, TABLES, table
from tallyhouse.sources import (
    batch,
    export_parquet,
    filter_day,
    incremental,
    incremental_by_change,
    is_empty,
    layer_path,
    read_csv,
    reassign_ids,
    snapshot,
    with_audit,
)
from tallyhouse.sources.jdbc import Split, jdbc_reader


def stamps(spark, *texts):
    return spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "id long, text string").selectExpr(
        "id", "cast(text as timestamp) at", "cast(text as timestamp_ntz) ntz", "cast(text as date) day", "text"
    )


def test_incremental_is_half_open(spark, rows):
    df = stamps(spark, "2024-01-14 23:59:59.999999", "2024-01-15 00:00:00", "2024-01-15 23:59:59.999999", "2024-01-16", None)
    assert rows(incremental(df, "at", "2024-01-15"), "id") == [(1,), (2,)]
    assert rows(incremental(df, "ntz", "2024-01-15"), "id") == [(1,), (2,)]
    assert snapshot(df) is df


def test_filter_day_by_type(spark, rows):
    df = stamps(spark, "2024-01-15", "2024-01-15 08:00:00", "2024-01-16").withColumn("n", F.lit(20240115))
    assert rows(filter_day(df, "text", "2024-01-15"), "id") == [(0,)]
    assert rows(filter_day(df, "at", "2024-01-15"), "id") == [(0,), (1,)]
    assert rows(filter_day(df, "day", "2024-01-15"), "id") == [(0,), (1,)]
    assert filter_day(df, "n", "20240115").count() == 3


def test_changed_rows_are_not_missed(spark, rows):
    data = [
        (1, "2024-01-01", None),
        (2, "2024-01-01", "2024-01-02"),
        (3, "2024-01-02", None),
        (4, "2024-01-02", "2024-01-03"),
    ]
    df = spark.createDataFrame(data, "id long, c string, u string").selectExpr(
        "id", "cast(c as timestamp) created_at", "cast(u as timestamp) updated_at"
    )
    assert rows(incremental_by_change(df, "2024-01-02"), "id") == [(2,), (3,)]


def test_audit_batch_and_empty(spark):
    df = with_audit(spark.range(3), "2024-01-15")
    assert df.columns == ["id", "ingested_at", "ingestion_date"]
    assert batch(df, "2024-01-15").count() == 3
    assert is_empty(batch(df, "2024-01-16")) and not is_empty(df)


def test_csv_with_quotes_and_commas(spark, tmp_path, rows):
    path = tmp_path / "warehouse.csv"
    path.write_text(
        '"id","name","address","capacity_sqm","created_at"\n'
        '1,"North, main","Ward ""7"", District 1","370.00","2025-01-29 16:18:53.835482"\n'
    )
    df = read_csv(spark, str(path), "id long, name string, address string, capacity_sqm decimal(12,2), created_at timestamp")
    row = df.first()
    assert (row.name, row.address) == ("North, main", 'Ward "7", District 1')
    assert row.created_at == datetime(2025, 1, 29, 16, 18, 53, 835482)


def test_malformed_csv_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,amount\nx,1\n")
    with pytest.raises(Exception):
        read_csv(spark, str(path), "id long, amount decimal(12,2)").collect()


def test_reassigned_ids_keep_order_and_columns(spark, rows):
    df = spark.createDataFrame([("b", 20), ("a", 10), ("c", 900_000)], "name string, id long")
    assert rows(reassign_ids(df)) == [("a", 1), ("b", 2), ("c", 3)]


def test_export_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    export_parquet(spark.range(5), path)
    export_parquet(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


class RecordingReader:
    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **values):
        self.seen.update(values)
        return self


class RecordingSession:
    def __init__(self):
        self.read = RecordingReader()


def test_jdbc_query_is_wrapped_and_split():
    plain = jdbc_reader(RecordingSession(), "jdbc:x", "select 1", {"user": "u"}).seen
    assert plain["dbtable"] == "(select 1) as source" and plain["user"] == "u"
    assert "numPartitions" not in plain
    split = jdbc_reader(RecordingSession(), "jdbc:x", "select 1", None, Split("id", 0, 100, 8)).seen
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", 0, 100, 8)


def test_catalog_covers_every_table():
    assert len(TABLES) == 24
    for name, spec in TABLES.items():
        names = spec.schema.names
        assert set(spec.key) <= set(names)
        assert spec.event_time in names
        for column, (parent, key) in spec.references.items():
            assert column in names and key in table(parent).schema.names
    assert sum(spec.mode == INCREMENTAL for spec in TABLES.values()) == 6


def test_unknown_names_are_reported():
    with pytest.raises(KeyError, match="known"):
        table("nope")
    with pytest.raises(ValueError, match="layer"):
        layer_path("/x", "bronze", "orders")
