"""Helpers that several operators share: words, hashes, stored intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyhouse.session import checkpoint_dir

#: Memory of a worker's word cache is bounded by this many entries.
CACHE_ENTRIES = 200_000
#: Bytes of a record batch that are turned into Python values at a time.
PIECE_BYTES = 2 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def text_bytes(text: str | None) -> bytes:
    """UTF-8 of a text; nothing for null."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


class Memo(dict):
    """A bounded cache that computes absent keys.

    When it is full it becomes the older half and starts anew; keys found in
    the older half come back, so what is used often stays. Keys longer than
    ``longest`` are not kept.
    """

    def __init__(self, compute: Callable, entries: int = CACHE_ENTRIES, longest: int = 64):
        super().__init__()
        self.compute, self.entries, self.longest, self.older = compute, entries // 2, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[key] = value


def word_hashes() -> Memo:
    """Cache of 64-bit word hashes."""
    return Memo(xxhash.xxh3_64_intdigest)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash for each run of ``size`` word hashes, in order."""
    count = len(hashes) - size + 1
    if count <= 0:
        return hashes[:0]
    out = hashes[:count].copy()
    for k in range(1, size):
        out = mixed(out * MIX) + hashes[k : k + count]
    return mixed(out)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The rows outlive the executors that made them, and work with side
    effects, such as writing files, runs once for all later readers.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind; for results that are stored, so that nothing reads these files again."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def new_folder(spark: SparkSession, name: str) -> str:
    """Address of a new folder in the shared folder; nothing is made yet."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide(spark: SparkSession) -> int:
    """Partition count for a shuffle asked for by hand: the session's own."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


Columns = dict[str, list]


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def map_columns(df: DataFrame, schema: T.StructType, work: Callable[[Iterator[Columns]], Iterator[Columns]]) -> DataFrame:
    """Run ``work`` over each partition's record batches, as lists of Python values by column.

    Integers beside nulls stay integers. A batch of long values comes in pieces of about ``PIECE_BYTES``.
    ``work`` may return any number of batches, each a list for every column of ``schema``.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(piece.to_pydict() for batch in batches for piece in pieces(batch)):
            yield pa.RecordBatch.from_pydict({f.name: columns[f.name] for f in arrow}, schema=arrow)
        # A worker lives on for other tasks; what this one no longer needs goes back to the system.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
