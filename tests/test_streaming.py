from __future__ import annotations

import pytest

from tallyhouse.operators.activity import daily_activity
from tallyhouse.streaming import cart_sessions, deduplicated, read_stream, stream_daily_activity, write_stream

DDL = "id long, cart_id long, activity_type string, created_at timestamp"


@pytest.fixture
def feed(spark, tmp_path):
    """Write batches of events as files and run a job over what is new."""
    source = tmp_path / "in"
    source.mkdir()

    def push(*events):
        spark.createDataFrame(events, "id long, cart_id long, activity_type string, at string").selectExpr(
            "id", "cart_id", "activity_type", "cast(at as timestamp) created_at"
        ).coalesce(1).write.mode("append").parquet(str(source))

    def run(job, name):
        out = str(tmp_path / name)
        stream = job(read_stream(spark, str(source), DDL))
        write_stream(stream, out, f"{out}-state").awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    return push, run


def test_days_close_once_and_late_events_are_dropped(feed, rows):
    push, run = feed
    push((1, 1, "view", "2024-01-01 10:00:00"), (2, 1, "view", "2024-01-01 11:00:00"), (3, 1, "view", "2024-01-03 12:00:00"))
    first = run(stream_daily_activity, "daily")
    assert [row.activities for row in first.collect()] == [2]
    # The first day is closed; the second is still open and takes a late event.
    push((4, 1, "view", "2024-01-01 12:00:00"), (5, 1, "view", "2024-01-02 23:00:00"), (6, 1, "view", "2024-01-05 12:00:00"))
    second = run(stream_daily_activity, "daily")
    counts = {str(row.window_start)[:10]: row.activities for row in second.collect()}
    assert counts == {"2024-01-01": 2, "2024-01-02": 1, "2024-01-03": 1}


def test_repeats_are_dropped_across_runs(feed, rows):
    push, run = feed
    push((1, 1, "view", "2024-01-01 10:00:00"), (1, 1, "view", "2024-01-01 10:00:00"))
    run(deduplicated, "unique")
    push((1, 1, "view", "2024-01-01 10:00:00"), (2, 1, "view", "2024-01-01 11:00:00"))
    assert rows(run(deduplicated, "unique"), "id") == [(1,), (2,)]


def test_cart_expires_after_seven_idle_days(feed, rows):
    push, run = feed
    push((1, 7, "view", "2024-01-01 00:00:00"), (2, 7, "view", "2024-01-05 00:00:00"), (3, 8, "view", "2024-01-08 00:00:00"))
    assert run(cart_sessions, "carts").count() == 0
    push((4, 9, "view", "2024-01-14 00:00:00"))
    assert rows(run(cart_sessions, "carts"), "cart_id", "touches") == [(7, 2)]


def test_batch_and_stream_agree(spark, feed, rows):
    push, run = feed
    push(*[(n, n % 3, "view", f"2024-01-{1 + n % 20:02d} 10:00:00") for n in range(60)])
    streamed = run(stream_daily_activity, "agree")
    batch = daily_activity(spark.createDataFrame(
        [(n, n % 3, "view", f"2024-01-{1 + n % 20:02d} 10:00:00") for n in range(60)], "id long, cart_id long, activity_type string, at string"
    ).selectExpr("*", "cast(at as timestamp) created_at"))
    closed = batch.filter("window_start < timestamp'2024-01-19 00:00:00'")
    assert rows(streamed) == rows(closed)


@pytest.mark.parametrize("files", [1, 7])
def test_counts_do_not_depend_on_file_layout(spark, tmp_path, rows, files):
    """Files out of time order, as a folder or a single file: nothing is late within one run."""
    events = spark.createDataFrame(
        [(n, n % 5, "view", f"2024-01-{1 + (n * 7) % 25:02d} {n % 24:02d}:00:00") for n in range(400)],
        "id long, cart_id long, activity_type string, at string",
    ).selectExpr("id", "cart_id", "activity_type", "cast(at as timestamp) created_at")
    path = str(tmp_path / "events.parquet")
    events.repartition(files, "id").write.parquet(path)
    if files == 1:
        (path,) = map(str, (tmp_path / "events.parquet").glob("part-*.parquet"))
    out = str(tmp_path / "out")
    stream = stream_daily_activity(read_stream(spark, path, DDL))
    write_stream(stream, out, f"{out}-state").awaitTermination()
    closed = daily_activity(events).filter("window_start < timestamp'2024-01-24 00:00:00'")
    assert rows(spark.read.schema(stream.schema).parquet(out)) == rows(closed)
