"""Near-duplicate documents by 64-bit SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint bit is set when it is set in over half of the hashes of a text's shingles.
Fingerprints that differ in at most ``radius`` bits are linked.

Covering: every bit place gets a non-zero vector of ``radius + 1`` bits, and each of the
``2^(radius+1) - 1`` non-zero vectors v makes a table whose mask takes the places with an odd
product with v. Any ``radius`` places leave some v that is even with all of them, so two fingerprints
that differ in these places only are equal under that v's mask: the pair surely meets in its table.

Equal fingerprints are one node from the start. A bucket of two is decided by itself; a larger one is compared
in one task, which returns a spanning forest. A bucket above ``BUCKET`` fingerprints is dealt again by a second
family of masks with other vectors, which covers all pairs as well, and so on. Each family fixes about half of the
bits that were free (at most 22, 16 and 12 are after the second to fourth), which bounds the different fingerprints
of a bucket whatever the data: no case is left out, and no task compares more than ``BUCKET``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import Columns, map_columns, stored, text_bytes, wide
from tallyhouse.llm.components import components

BITS = 64
#: Seed of the shingle hash.
SEED = 42
#: Fingerprints of a bucket that one task compares.
BUCKET = 2048
#: Shingles of a text that are hashed at a time.
BLOCK = 1 << 15

FINGERPRINT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("f", T.LongType(), False)])
LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def shingle_hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``size`` words, repeats included, in blocks; fewer words are one run."""
    joined = b" ".join(words)
    size = min(size, len(words))
    ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
    starts = [0, *[end + 1 for end in ends[:-1]]]
    for k in range(0, len(words) - size + 1, BLOCK):
        last = min(k + BLOCK, len(words) - size + 1)
        runs = map(joined.__getitem__, map(slice, starts[k:last], ends[k + size - 1 : last + size - 1]))
        yield np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, last - k)


def fingerprint(text: str | None, size: int) -> int:
    """The fingerprint as a signed number; 0 without words."""
    words = text_bytes(text).lower().split()
    if not words:
        return 0
    counts, total = np.zeros(BITS, dtype=np.int64), 0
    for hashes in shingle_hashes(words, size):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.int32)
        total += len(hashes)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(documents: DataFrame, size: int) -> DataFrame:
    """``doc_id, f`` of each row."""

    def computed(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "f": [fingerprint(text, size) for text in batch["text"]]}

    return map_columns(documents.select(F.col("doc_id").cast("long"), "text"), FINGERPRINT, computed)


def masks(radius: int, family: int = 0) -> list[int]:
    """A covering family: one signed 64-bit mask for each table."""
    tables = (1 << (radius + 1)) - 1
    dealt = np.random.default_rng(family).permutation(BITS) % tables + 1
    found = []
    for v in range(1, tables + 1):
        odd = [int(vector & v).bit_count() % 2 == 1 for vector in dealt.tolist()]
        found.append(int(np.packbits(odd, bitorder="little").view("<i8")[0]))
    return found


def postings(rows: DataFrame, radius: int, family: int) -> DataFrame:
    """``f, bucket``: each fingerprint under every mask, inside the ``bucket`` that it comes from, if any."""
    outer = [F.col("bucket")] if "bucket" in rows.columns else []
    keys = [F.xxhash64(*outer, F.lit(family), F.lit(k), F.col("f").bitwiseAND(F.lit(m))) for k, m in enumerate(masks(radius, family))]
    return rows.select("f", F.explode(F.array(*keys)).alias("bucket"))


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among different fingerprints."""
    root, found = np.arange(len(values)), []
    for row in range(len(values) - 1):
        near = row + 1 + np.flatnonzero(np.bitwise_count(values[row + 1 :] ^ values[row]) <= radius)
        while len(near := near[root[near] != root[row]]):
            found.append((row, int(near[0])))
            root[root == root[near[0]]] = root[row]
    return found


def compared(members: DataFrame, radius: int) -> DataFrame:
    """Links within each bucket of ``members (bucket, f)``."""

    def searched(batches: Iterator[Columns]) -> Iterator[Columns]:
        bucket, held = None, []

        def links() -> Columns:
            values = np.array(held, dtype=np.int64)
            pairs = forest(values.view(np.uint64), radius) if len(held) > 1 else []
            return {"a": [held[x] for x, _ in pairs], "b": [held[y] for _, y in pairs]}

        for batch in batches:
            for own, f in zip(batch["bucket"], batch["f"]):
                if own != bucket:
                    yield links()
                    bucket, held = own, []
                held.append(f)
        yield links()

    dealt = members.repartition(wide(members.sparkSession), "bucket").sortWithinPartitions("bucket", "f")
    return map_columns(dealt.select("bucket", "f"), LINK, searched)


def covered_links(distinct: DataFrame, radius: int, bucket_size: int = BUCKET) -> DataFrame:
    """``(a, b)`` of different fingerprints; every pair within the radius is connected by them."""
    links, rows, family = [], distinct.select("f"), 0
    while True:
        # A fingerprint is in a bucket once; two tables whose hashes agree only add members to compare.
        posted = postings(rows, radius, family).distinct() if family else postings(rows, radius, family)
        buckets = stored(
            posted.groupBy("bucket").agg(F.count("*").alias("n"), F.min("f").alias("a"), F.max("f").alias("b")).where("n > 1"),
            "simhash-buckets",
        )
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
        links.append(buckets.where(F.col("n") == 2).where(near).select("a", "b"))
        some = buckets.where(F.col("n").between(3, bucket_size)).select("bucket")
        links.append(compared(posted.join(some, "bucket"), radius))
        large = buckets.where(F.col("n") > bucket_size).select("bucket")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, links)
        rows, family = stored(posted.join(large, "bucket"), "simhash-large-buckets"), family + 1


def simhash_near_duplicates(documents: DataFrame, size: int = 5, radius: int = 4, bucket_size: int = BUCKET) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``documents``.

    ``fingerprint`` has 16 lower-case hex digits; ``component_id`` is the smallest doc_id reachable over links of
    fingerprints that differ in at most ``radius`` bits, the row's own included.

    A text with fewer words than ``size`` has one shingle, all its words; a text without words, or null, has the
    fingerprint zero and is linked like any other. Texts of any length are hashed in blocks of shingles. Rows that
    repeat a doc_id keep fingerprints and components of their own. A row without a doc_id has a fingerprint, links
    nothing, and its component is that of the other rows with this fingerprint, null without any. Other columns
    are ignored, whatever their names. An empty table gives an empty result.
    """
    known = stored(fingerprints(documents, size), "simhash-fingerprints")
    distinct = stored(known.where("doc_id is not null").groupBy("f").agg(F.min("doc_id").alias("id")), "simhash-distinct")
    found = stored(covered_links(distinct, radius, bucket_size), "simhash-links")
    roots = stored(components(found).join(distinct.withColumnRenamed("id", "doc"), F.col("id") == F.col("f")), "simhash-roots")
    least = roots.groupBy("root").agg(F.min("doc").alias("component"))
    linked = roots.join(least, "root").select("f", "component")
    classes = stored(distinct.join(linked, "f", "left").select("f", F.coalesce("component", "id").alias("component_id")), "simhash-classes")
    return known.join(classes, "f", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id"
    )
