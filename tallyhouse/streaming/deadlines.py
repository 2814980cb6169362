"""Deadlines that fall due by event time: unconfirmed orders, failed deliveries, idle carts.

One state machine serves all three. Events of a key may come in any order and in any file; they wait in the state until the
watermark has passed them, are then taken in order of time, and what falls due is emitted once, at
its own moment. The batch twin :func:`due_by` gives the same rows from a whole table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tallyhouse.operators.carts import IDLE_DAYS
from tallyhouse.operators.shipping import MAX_FAILED_ATTEMPTS

# Fixed value: minutes to confirm an order.
CONFIRM_MINUTES = 30
SECOND = 1_000_000
DECISION = "kind string, id bigint, decision string, at_micros bigint"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# Events that count, in the order of their names.
EVENTS = ("confirmed", "failed", "placed", "touch")
BUCKETS = 1024
NEVER = np.iinfo(np.int64).max
# How waiting events and the progress of ids lie in the state.
WAITING = np.dtype([("id", "<i8"), ("at", "<i8"), ("event", "i1")])
PROGRESS = np.dtype([("id", "<i8"), ("due", "<i8"), ("failures", "<i4"), ("settled", "?")])
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Terms:
    """Microseconds to confirm an order and that a cart may lie idle, and failed deliveries that send a parcel back."""

    confirm: int = CONFIRM_MINUTES * 60 * SECOND
    idle: int = IDLE_DAYS * 86_400 * SECOND
    attempts: int = MAX_FAILED_ATTEMPTS


@dataclass
class Progress:
    """What is known of a key: when something falls due, failed deliveries so far, and whether it is settled."""

    due: int | None = None
    failures: int = 0
    settled: bool = False

    def due_until(self, moment: int, kind: str) -> list[tuple[str, int]]:
        """Decisions that fall due before ``moment``."""
        if self.due is None or self.due >= moment:
            return []
        decision, at = ("cancelled" if kind == "order" else "expired"), self.due
        self.due, self.settled = None, kind == "order"
        return [(decision, at)]

    def take(self, kind: str, event: str, at: int, terms: Terms) -> list[tuple[str, int]]:
        """Apply one event; decisions that were due before it come first."""
        found = self.due_until(at, kind)
        if self.settled:
            return found
        if event == "placed" and self.due is None:
            self.due = at + terms.confirm
        elif event == "confirmed":
            self.due, self.settled = None, True
        elif event == "failed":
            self.failures += 1
            if self.failures == terms.attempts:
                found.append(("returned", at))
                self.settled = True
        elif event == "touch":
            self.due = at + terms.idle
        return found


def _rows(chunks: Iterable[bytes], kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(chunks), kind)


class Deadlines(StatefulProcessor):
    """The state machine of many ids of one kind: waiting events, progress, and a timer for what comes next.

    A call to the state costs far more than an event, so the ids of a bucket share one entry of each state and one timer,
    and every id still has a :class:`Progress` of its own.
    """

    def __init__(self, terms: Terms):
        self.terms = terms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "chunk binary")
        self.progress = handle.getValueState("progress", "chunk binary")

    def _wake(self, micros: int) -> None:
        # Timers count milliseconds; the first one at or after the moment.
        self.handle.registerTimer(-(-micros // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            known = part[part["event"] >= 0]
            if len(known):
                chunk = np.empty(len(known), WAITING)
                for name in WAITING.names:
                    chunk[name] = known[name].to_numpy()
                self.waiting.appendValue((chunk.tobytes(),))
                first = min(int(chunk["at"].min()), first if first is not None else NEVER)
        if first is not None:
            self._wake(first)
        return iter(())

    def _take(self, known: np.ndarray, events: np.ndarray, kind: str, passed: int) -> tuple[np.ndarray, list[tuple[int, str, int]]]:
        """Progress after ``events`` and the decisions due before ``passed``, id by id."""
        # Ids with neither an event nor anything due stay as they are.
        moved = np.isin(known["id"], events["id"]) | (known["due"] < passed)
        now = {number: Progress(due if due != NEVER else None, failures, settled) for number, due, failures, settled in known[moved].tolist()}
        found = []
        # At one moment a confirmation still counts, and events are taken in the order of their names.
        for number, at, event in events[np.lexsort((events["event"], events["at"], events["id"]))].tolist():
            if number not in now:
                now[number] = Progress()
            found += [(number, *decided) for decided in now[number].take(kind, EVENTS[event], at, self.terms)]
        for number, state in now.items():
            found += [(number, *decided) for decided in state.due_until(passed, kind)]
        after = [(number, NEVER if p.due is None else p.due, p.failures, p.settled) for number, p in now.items()]
        return np.concatenate([known[~moved], np.array(after, PROGRESS)]), found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        kind, passed = key[0], timerValues.getCurrentWatermarkInMs() * 1000
        waiting = _rows((chunk for (chunk,) in self.waiting.get()), WAITING)
        stored = self.progress.get()
        known = _rows(stored or (), PROGRESS)
        over = waiting["at"] <= passed
        rest = waiting[~over]
        if over.any():
            if len(rest):
                self.waiting.put([(rest.tobytes(),)])
            else:
                self.waiting.clear()
        found = []
        if over.any() or (known["due"] < passed).any():
            known, found = self._take(known, waiting[over], kind, passed)
            self.progress.update((known.tobytes(),))
        following = min([int(rows.min()) for rows in (rest["at"], known["due"]) if len(rows)], default=NEVER)
        if following != NEVER:
            # Something due at the watermark itself is settled by the next one.
            self._wake(max(following, passed + 1000))
        if found:
            numbers, decisions, moments = zip(*found)
            yield pd.DataFrame({"kind": kind, "id": numbers, "decision": decisions, "at_micros": moments})

    def close(self) -> None:
        pass


def stream_deadlines(events: DataFrame, terms: Terms = Terms(), lateness: str = "1 day", buckets: int = BUCKETS) -> DataFrame:
    """``kind, id, decision, at`` as moments are passed, from events ``kind, id, event, created_at``.

    Kinds and events: order (placed, confirmed), delivery (failed), cart (touch). Other events are passed over, as are rows without
    an id or a moment. Ids share the state of ``buckets`` buckets of each kind; the number stays fixed as long as a checkpoint is
    used. Needs the state store that :func:`with_timers` sets.
    """
    known = events.filter("id is not null and created_at is not null and kind is not null")
    number = F.coalesce(F.array_position(F.array(*[F.lit(name) for name in EVENTS]), F.col("event")), F.lit(0)) - 1
    timed = known.select(
        "kind",
        F.col("id").cast("bigint").alias("id"),
        number.cast("tinyint").alias("event"),
        F.col("created_at").cast("timestamp").alias("created_at"),
    )
    marked = timed.withWatermark("created_at", lateness).withColumn("at", F.unix_micros("created_at"))
    decided = (
        marked.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
        .groupBy("kind", "bucket")
        .transformWithStateInPandas(
            statefulProcessor=Deadlines(terms), outputStructType=DECISION, outputMode="Append", timeMode="EventTime"
        )
    )
    return decided.select("kind", "id", "decision", F.timestamp_micros("at_micros").alias("at"))


class with_timers:
    """Streams started inside keep their state where timers are supported."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.before = self.spark.conf.get(STATE_STORE, None)
        self.spark.conf.set(STATE_STORE, ROCKS)
        return self.spark

    def __exit__(self, *_):
        if self.before is None:
            self.spark.conf.unset(STATE_STORE)
        else:
            self.spark.conf.set(STATE_STORE, self.before)


def due_by(events: DataFrame, until, terms: Terms = Terms()) -> DataFrame:
    """The batch twin: what fell due before the moment ``until`` (a column), from events up to then.

    Orders and deliveries are settled by aggregates that combine before the shuffle, carts by the next touch.
    """
    at = F.unix_micros(F.col("created_at").cast("timestamp"))
    end = F.unix_micros(until.cast("timestamp"))
    known = events.filter("id is not null and created_at is not null").select("kind", F.col("id").cast("bigint").alias("id"), "event", at.alias("at"))
    known = known.withColumn("_end", end).filter("at <= _end")
    first = lambda event: F.min(F.when(F.col("event") == event, F.col("at")))
    due = F.col("placed") + terms.confirm
    orders = (
        known.filter("kind = 'order'")
        .groupBy("id", "_end")
        .agg(first("placed").alias("placed"), first("confirmed").alias("confirmed"))
        .withColumn("at", due)
        .filter((F.col("at") < F.col("_end")) & (F.col("confirmed").isNull() | (F.col("confirmed") > F.col("at"))))
        .select(F.lit("order").alias("kind"), "id", F.lit("cancelled").alias("decision"), "at")
    )
    nth = F.row_number().over(Window.partitionBy("id").orderBy("at"))
    returned = (
        known.filter("kind = 'delivery' and event = 'failed'")
        .withColumn("_nth", nth)
        .filter(F.col("_nth") <= terms.attempts)
        .filter(F.col("_nth") == terms.attempts)
        .select("kind", "id", F.lit("returned").alias("decision"), "at")
    )
    following = F.lead("at").over(Window.partitionBy("id").orderBy("at"))
    idle = (
        known.filter("kind = 'cart' and event = 'touch'")
        .withColumn("_next", following)
        .withColumn("at", F.col("at") + terms.idle)
        .filter((F.col("at") < F.col("_end")) & (F.col("_next").isNull() | (F.col("_next") > F.col("at"))))
        .select("kind", "id", F.lit("expired").alias("decision"), "at")
    )
    every = orders.unionByName(returned).unionByName(idle)
    return every.select("kind", "id", "decision", F.timestamp_micros("at").alias("at"))
