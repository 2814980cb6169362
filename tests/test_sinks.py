from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse.sinks import Mode, day_partition, namespace, write


def frame(spark, *rows):
    return spark.createDataFrame(rows, "id long, ds string")


def test_append_adds(spark, tmp_path):
    path = str(tmp_path / "t")
    write(frame(spark, (1, "a")), path)
    write(frame(spark, (1, "a")), path)
    assert spark.read.parquet(path).count() == 2


def test_reloading_a_partition_is_idempotent(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    write(frame(spark, (1, "a"), (2, "b")), path, Mode.PARTITIONS, ["ds"])
    for _ in range(2):
        write(frame(spark, (3, "b")), path, Mode.PARTITIONS, ["ds"])
    assert rows(spark.read.parquet(path), "id", "ds") == [(1, "a"), (3, "b")]


def test_replacing_the_table_leaves_no_stale_partition(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    write(frame(spark, (1, "Active")), path, Mode.TABLE, ["ds"])
    write(frame(spark, (1, "Churned")), path, Mode.TABLE, ["ds"])
    assert rows(spark.read.parquet(path), "id", "ds") == [(1, "Churned")]


def test_partitions_need_columns(spark, tmp_path):
    with pytest.raises(ValueError):
        write(frame(spark, (1, "a")), str(tmp_path / "t"), Mode.PARTITIONS)


def test_day_partition(spark, tmp_path):
    df = spark.range(1).selectExpr("id", "timestamp'2024-01-15 23:30:00' created_at")
    path = tmp_path / "t"
    write(day_partition(df, "created_at"), str(path), Mode.PARTITIONS, ["created_at_day"])
    assert [p.name for p in path.glob("created_at_day=*")] == ["created_at_day=2024-01-15"]


def test_clustered_write_makes_few_files(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(0, 1000, 1, 8).withColumn("ds", (F.col("id") % 3).cast("string"))
    write(df, str(path), Mode.TABLE, ["ds"])
    assert len(list(Path(path).rglob("*.parquet"))) == 3


def test_records_per_file(spark, tmp_path):
    path = tmp_path / "t"
    write(spark.range(0, 100, 1, 1), str(path), max_records_per_file=25)
    assert len(list(Path(path).rglob("*.parquet"))) == 4


def test_namespace(spark):
    namespace(spark, "shop_test")
    namespace(spark, "shop_test")
    assert spark.catalog.databaseExists("shop_test")
