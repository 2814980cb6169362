"""Deadlines by event time: the stream equals the batch twin on shuffled files."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.streaming import read_stream, write_stream
from tallyhouse.streaming.deadlines import Progress, Terms, due_by, stream_deadlines, with_timers

DDL = "kind string, id long, event string, created_at timestamp"
START = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "kind string, id long, event string, s double").selectExpr(
        "kind", "id", "event", "timestamp_micros(cast(s * 1e6 as bigint) + unix_micros(timestamp'2024-01-01 00:00:00')) created_at")


def run(spark, folder, out):
    events = read_stream(spark, folder, DDL)
    with with_timers(spark):
        query = write_stream(stream_deadlines(events, lateness="1 day"), out, f"{out}-state")
    query.awaitTermination()
    return spark.read.schema("kind string, id bigint, decision string, at timestamp").parquet(out)


def as_set(df):
    rows = [tuple(r) for r in df.select("kind", "id", "decision", "at").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


MINUTE, DAY = 60.0, 86_400.0


@pytest.fixture(scope="module")
def events(spark):
    draw = random.Random(3)
    rows = []
    for n in range(60):
        placed = draw.randrange(0, 20) * DAY + draw.randrange(1000)
        rows.append(("order", n, "placed", placed))
        if n % 3:
            rows.append(("order", n, "confirmed", placed + draw.choice([0, 5, 29.5, 30, 30.5, 600]) * MINUTE))
        rows += [("delivery", n, "failed", placed + draw.randrange(9) * DAY / 3) for _ in range(draw.randrange(5))]
        rows += [("cart", n, "touch", draw.randrange(0, 30) * DAY / 2 + draw.randrange(99)) for _ in range(draw.randrange(5))]
    rows += [("order", None, "placed", 1.0), ("cart", 5, "other", 3.0), ("order", 900, "confirmed", 50.0)]
    rows.append(("cart", 1000, "touch", 40 * DAY))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("files", [1, 6])
def test_stream_equals_batch_on_shuffled_files(spark, tmp_path, events, files):
    folder = str(tmp_path / "in")
    df = frame(spark, events)
    df.repartition(files).write.parquet(folder)
    found = as_set(run(spark, folder, str(tmp_path / "out")))
    until = F.lit(START + timedelta(days=39)).cast("timestamp")
    assert found == as_set(due_by(df, until))
    assert {decision for _, _, decision, _ in found} == {"cancelled", "returned", "expired"}


def test_a_second_run_goes_on_where_the_first_stopped(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    first = [("order", 1, "placed", 0.0), ("order", 2, "placed", 2 * DAY), ("delivery", 7, "failed", 0.0), ("cart", 4, "touch", 0.0), ("cart", 9, "touch", 3 * DAY)]
    frame(spark, first).coalesce(1).write.mode("append").parquet(folder)
    one = as_set(run(spark, folder, out))
    assert {(kind, n, d) for kind, n, d, _ in one} == {("order", 1, "cancelled")}
    second = [
        ("order", 2, "confirmed", 2 * DAY + 10 * MINUTE), ("delivery", 7, "failed", 2.5 * DAY), ("delivery", 7, "failed", 2.6 * DAY),
        ("cart", 4, "touch", 6 * DAY), ("cart", 9, "touch", 30 * DAY),
    ]
    frame(spark, second).coalesce(1).write.mode("append").parquet(folder)
    two = as_set(run(spark, folder, out)) - one
    at = {(kind, n, d): (t - START).total_seconds() / DAY for kind, n, d, t in two}
    assert at == {("delivery", 7, "returned"): 2.6, ("cart", 4, "expired"): 13.0, ("cart", 9, "expired"): 10.0}


def test_progress_row_by_row():
    terms = Terms(confirm=30, idle=70, attempts=3)
    order = Progress()
    assert order.take("order", "placed", 0, terms) == [] and order.take("order", "confirmed", 30, terms) == []
    assert order.due_until(1000, "order") == []
    late = Progress()
    late.take("order", "placed", 0, terms)
    assert late.take("order", "confirmed", 31, terms) == [("cancelled", 30)]
    cart = Progress()
    cart.take("cart", "touch", 0, terms)
    assert cart.take("cart", "touch", 70, terms) == [] and cart.take("cart", "touch", 200, terms) == [("expired", 140)]
    parcel = Progress()
    assert [parcel.take("delivery", "failed", t, terms) for t in (1, 2, 3, 4)] == [[], [], [("returned", 3)], []]


def test_state_is_kept_by_bucket_and_not_by_id(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(20_000).selectExpr(
        "'order' kind", "id", "'placed' event", "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 7) created_at"
    ).unionByName(frame(spark, [("cart", 1, "touch", 3 * DAY)])).coalesce(1).write.parquet(folder)
    with with_timers(spark):
        query = write_stream(stream_deadlines(read_stream(spark, folder, DDL)), out, f"{out}-state")
    query.awaitTermination()
    found = spark.read.parquet(out)
    assert found.count() == found.select("id").distinct().count() == 20_000
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) < 20_000
