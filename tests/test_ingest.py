"""Streaming ingest: days, late rows, replays and broken-off batches."""

from __future__ import annotations

import pytest

from tallyhouse.streaming import read_stream
from tallyhouse.streaming.ingest import ingest_stream, ingested, ledger, merge_batch

DDL = "id long, status string, created_at timestamp, version long"


@pytest.fixture
def feed(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "table")
    source.mkdir()

    def rows_of(*rows):
        return spark.createDataFrame(rows, "id long, status string, at string, version long").selectExpr(
            "id", "status", "cast(at as timestamp) created_at", "version")

    def push(*rows):
        rows_of(*rows).coalesce(1).write.mode("append").parquet(str(source))

    def run(files=1):
        ingest_stream(read_stream(spark, str(source), DDL, files), path, ["id"], "created_at", ["version"]).awaitTermination()

    return rows_of, push, run, path


def state(spark, path):
    return {(r.id, r.status, str(r.created_at_day)) for r in ingested(spark, path).collect()}


def test_batches_merge_and_late_rows_find_their_day(spark, feed):
    _, push, run, path = feed
    push((1, "new", "2024-01-01 10:00:00", 1), (2, "new", "2024-01-02 10:00:00", 1), (2, "newer", "2024-01-02 10:00:00", 2))
    run()
    push((3, "late", "2024-01-01 23:00:00", 1), (1, "done", "2024-01-01 10:00:00", 3), (4, "timeless", None, 1))
    run()
    expected = {(1, "done", "2024-01-01"), (2, "newer", "2024-01-02"), (3, "late", "2024-01-01"), (4, "timeless", "None")}
    assert state(spark, path) == expected
    assert ingested(spark, path).count() == 4
    run()
    assert state(spark, path) == expected
    push((1, "stale", "2024-01-01 10:00:00", 2), (5, "timeless too", None, 1))
    run()
    assert state(spark, path) == expected | {(5, "timeless too", "None")}
    assert sorted(r.batch for r in ledger(spark, path).collect()) == [0, 1, 2]


def test_a_replayed_batch_changes_nothing(spark, feed):
    rows_of, _, _, path = feed
    one = rows_of((1, "a", "2024-01-01 10:00:00", 1), (2, "b", "2024-01-02 10:00:00", 1))
    merge_batch(one, 0, path, ["id"], "created_at", ["version"])
    merge_batch(rows_of((1, "c", "2024-01-01 10:00:00", 2)), 1, path, ["id"], "created_at", ["version"])
    before = state(spark, path), sorted(map(str, ledger(spark, path).collect()))
    merge_batch(one, 0, path, ["id"], "created_at", ["version"])
    merge_batch(rows_of((1, "never", "2024-01-01 10:00:00", 9)), 1, path, ["id"], "created_at", ["version"])
    assert (state(spark, path), sorted(map(str, ledger(spark, path).collect()))) == before


@pytest.mark.parametrize("broken_at", ["replace", "ledger"])
def test_a_batch_that_broke_off_goes_on_from_what_was_staged(spark, feed, monkeypatch, broken_at):
    """The days are lost between their removal and their replacement; the staged copy brings them back."""
    from tallyhouse.streaming import ingest

    rows_of, _, _, path = feed
    merge_batch(rows_of((1, "a", "2024-01-01 10:00:00", 1), (2, "b", "2024-01-02 10:00:00", 1)), 0, path, ["id"], "created_at", ["version"])
    real = ingest.write

    def breaking(df, target, *args, **kwargs):
        if target == (f"{path}/table" if broken_at == "replace" else f"{path}/ledger"):
            if broken_at == "replace":
                ingest.drop_partition(spark, target, "created_at_day", "2024-01-01")
            raise OSError("executor and driver lost")
        real(df, target, *args, **kwargs)

    two = rows_of((3, "c", "2024-01-01 11:00:00", 1))
    monkeypatch.setattr(ingest, "write", breaking)
    with pytest.raises(OSError):
        merge_batch(two, 1, path, ["id"], "created_at", ["version"])
    monkeypatch.setattr(ingest, "write", real)
    merge_batch(two, 1, path, ["id"], "created_at", ["version"])
    assert state(spark, path) == {(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", "2024-01-01")}
    assert ingested(spark, path).count() == 3


def test_an_empty_batch_is_entered(spark, feed):
    rows_of, _, _, path = feed
    merge_batch(rows_of((1, "a", "2024-01-01 10:00:00", 1)).limit(0), 0, path, ["id"], "created_at", ["version"])
    assert [(r.batch, r.rows) for r in ledger(spark, path).collect()] == [(0, 0)]
