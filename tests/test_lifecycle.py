from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import lifecycle
from tallyhouse.operators.lifecycle import compact, expire_partitions, keep_recent, latest_by_key, packed, scd2_merge
from tallyhouse.session import checkpoint_dir, materialise
from tallyhouse.sinks import Mode, write

VERSIONS = "id long, tier string, valid_from date, valid_to date, is_current boolean"


@pytest.fixture
def known(spark):
    start = date(2024, 1, 1)
    return spark.createDataFrame(
        [
            (1, "Bronze", start, None, True),
            (2, "Gold", start, None, True),
            (3, None, start, None, True),
            (4, "Silver", start, None, True),
            (2, "Silver", date(2023, 1, 1), start, False),
        ],
        VERSIONS,
    )


@pytest.fixture
def incoming(spark):
    return spark.createDataFrame([(1, "Silver"), (2, "Gold"), (3, None), (5, "Bronze")], "id long, tier string")


def test_scd2_versions(known, incoming, rows):
    merged = scd2_merge(known, incoming, "id", ["tier"], "2024-02-01")
    new, old = date(2024, 2, 1), date(2024, 1, 1)
    assert rows(merged.filter("is_current"), "id", "tier", "valid_from") == [
        (1, "Silver", new), (2, "Gold", old), (3, None, old), (5, "Bronze", new)]
    assert rows(merged.filter("not is_current"), "id", "tier", "valid_to") == [
        (1, "Bronze", new), (2, "Silver", old), (4, "Silver", new)]


def test_scd2_same_snapshot_changes_nothing(known, incoming, rows):
    once = scd2_merge(known, incoming, "id", ["tier"], "2024-02-01")
    twice = scd2_merge(once, incoming, "id", ["tier"], "2024-02-01")
    assert rows(twice) == rows(once)


def test_scd2_may_keep_missing_keys_open(known, incoming):
    merged = scd2_merge(known, incoming, "id", ["tier"], "2024-02-01", close_missing=False)
    assert merged.filter("id = 4 and is_current").count() == 1


def test_latest_by_key(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, None, "x"), (2, 0, "y")], "k long, t int, v string")
    assert rows(latest_by_key(df, ["k"], ["t"])) == [(1, 3, "c"), (2, 0, "y")]


def test_retention_by_layer(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-02-01")], "id long, d string").selectExpr(
        "id", "cast(d as timestamp) at")
    assert rows(keep_recent(df, "raw", "2024-02-01", "at"), "id") == [(2,), (3,)]
    assert keep_recent(df, "silver", "2024-02-01", "at").count() == 3


def test_expired_partitions_are_dropped(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-18"), (3, "2024-02-01")], "id long, ingestion_date string")
    write(df, path, Mode.PARTITIONS, ["ingestion_date"])
    assert expire_partitions(spark, path, "ingestion_date", "quarantine", "2024-02-01") == ["2024-01-01"]
    assert rows(spark.read.parquet(path), "id") == [(2,), (3,)]
    assert expire_partitions(spark, str(tmp_path / "none"), "ingestion_date", "raw", "2024-02-01") == []


def test_compaction_keeps_rows_and_cuts_files(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(0, 4000, 1, 16).withColumn("ds", F.when(F.col("id") < 3000, "a").otherwise("b"))
    write(df, str(path), Mode.APPEND, ["ds"], cluster=False)
    files = {ds: len(list((path / f"ds={ds}").glob("*.parquet"))) for ds in "ab"}
    assert files == {"a": 12, "b": 4}
    setting = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert compact(spark, str(path), "ds", sort_by=["id"]) == ["a", "b"]
    assert {ds: len(list((path / f"ds={ds}").glob("*.parquet"))) for ds in "ab"} == {"a": 1, "b": 1}
    assert [r.id for r in spark.read.parquet(str(path / "ds=b")).collect()] == list(range(3000, 4000))
    assert spark.read.parquet(str(path)).selectExpr("count(*) n", "sum(id) s").first() == (4000, 4000 * 3999 // 2)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == setting


def test_compaction_leaves_well_filled_partitions_alone(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(0, 4000, 1, 4).withColumn("ds", F.lit("a"))
    write(df, str(path), Mode.APPEND, ["ds"], cluster=False)
    before = sorted(path.glob("ds=a/*.parquet"))
    assert compact(spark, str(path), "ds", target_bytes=3000) == []
    assert sorted(path.glob("ds=a/*.parquet")) == before


def test_materialised_rows_use_the_configured_folder(spark):
    df = materialise(spark.range(10).filter("id % 2 = 0"))
    assert df.count() == 5
    assert spark.conf.get("spark.checkpoint.dir") == checkpoint_dir(spark)
    assert "spark.checkpoint" not in df._jdf.queryExecution().toString()


def test_first_fit_decreasing():
    assert packed({"a": 70, "b": 60, "c": 40, "d": 30, "e": 5, "f": 200}, 100) == [["a", "d"], ["b", "c"]]
    assert packed({"a": 99, "b": 98}, 100) == []
    assert packed({}, 100) == []
    draw = random.Random(1)
    sizes = {f"f{n}": draw.randrange(1, 120) for n in range(200)}
    bins = packed(sizes, 100)
    assert all(sum(sizes[f] for f in files) <= 100 and len(files) > 1 for files in bins)
    names = [f for files in bins for f in files]
    assert len(names) == len(set(names))
    # What is left over has no partner among itself.
    left = sorted(sizes[f] for f in sizes if f not in names)
    assert len(left) < 2 or left[0] + left[1] > 100


@pytest.fixture
def mixed(spark, tmp_path):
    """One partition with a large file and small ones, one with a single file."""
    path = tmp_path / "t"
    spark.range(0, 60_000).selectExpr("id", "uuid() s", "'a' ds").coalesce(1).write.partitionBy("ds").parquet(str(path))
    spark.range(60_000, 60_400, 1, 5).selectExpr("id", "uuid() s", "'a' ds").write.mode("append").partitionBy("ds").parquet(str(path))
    spark.range(70_000, 70_010, 1, 1).selectExpr("id", "uuid() s", "'b' ds").write.mode("append").partitionBy("ds").parquet(str(path))
    (large,) = [f.name for f in (path / "ds=a").glob("*.parquet") if f.stat().st_size > 500_000]
    return path, large


def files(path, ds):
    return sorted(f.name for f in (path / f"ds={ds}").glob("*.parquet"))


def test_only_small_files_are_rewritten(spark, mixed, rows):
    path, large = mixed
    single = files(path, "b")
    before = rows(spark.read.parquet(str(path)))
    assert compact(spark, str(path), "ds", target_bytes=100_000, sort_by=["id"]) == ["a"]
    assert large in files(path, "a") and len(files(path, "a")) == 2
    assert files(path, "b") == single
    assert rows(spark.read.parquet(str(path))) == before
    assert not [f for f in path.iterdir() if f.name.startswith("_packing")]
    (small,) = [f for f in files(path, "a") if f != large]
    assert [r.id for r in spark.read.parquet(str(path / "ds=a" / small)).collect()] == list(range(60_000, 60_400))
    assert compact(spark, str(path), "ds", target_bytes=100_000) == []


@pytest.mark.parametrize("steps", [0, 1, 2])
def test_a_packing_that_broke_off_is_finished(spark, mixed, rows, monkeypatch, steps):
    path, _ = mixed
    before = rows(spark.read.parquet(str(path)))
    done = []

    def breaking(session, file, real=lifecycle.remove):
        if len(done) >= steps and "/_packing-" not in file:
            raise OSError("driver lost")
        done.append(file)
        real(session, file)

    monkeypatch.setattr(lifecycle, "remove", breaking)
    with pytest.raises(OSError):
        compact(spark, str(path), "ds", target_bytes=100_000)
    monkeypatch.undo()
    assert compact(spark, str(path), "ds", target_bytes=100_000) == []
    spark.catalog.refreshByPath(str(path))
    assert rows(spark.read.parquet(str(path))) == before
    assert len(files(path, "a")) == 2


def test_a_packing_without_a_journal_is_dropped(spark, mixed, rows):
    path, _ = mixed
    before = rows(spark.read.parquet(str(path)))
    (path / "_packing-dead" / "_bin=0").mkdir(parents=True)
    (path / "_packing-dead" / "_bin=0" / "part-0.parquet").write_bytes(b"half")
    assert compact(spark, str(path), "ds", target_bytes=100_000) == ["a"]
    assert rows(spark.read.parquet(str(path))) == before
