"""Near-duplicate documents by a join of posted MinHash coordinates.

Two documents are linked when the Jaccard similarity of their word-shingle sets reaches a
threshold. Steps:

1. Each text becomes its set of shingle hashes and a MinHash signature.
   Texts with equal sets are one document from here on.
2. Every document is posted under each (coordinate, value) of its signature.
   Values that one document alone has are dropped: nothing collides there.
3. A linked pair agrees in at least ``agree`` coordinates, so it meets in
   the posting lists of the ``coordinates - agree + 1`` rarest values of both.
   Only these prefixes are followed. Each document is tied to the first
   one of every list in its prefix; the components of the ties are families, and a
   linked pair is always within one family.
4. Families are cut into tiles: documents of similar set size, in parts of
   bounded bytes, each part meeting the parts whose sizes can still reach
   the similarity. Small families share tiles.
5. In a tile, the signature lists are merged again: the short lists give
   candidates with their collisions, the long lists are skipped and only probed
   for these candidates. Pairs with ``agree`` collisions are confirmed on
   the full sets. Pairs whose documents are connected already are passed
   over, so a tile returns a spanning forest of links.
6. Components of the links are the near-duplicate groups.

No step makes all pairs of a group as rows; a tile holds a bounded number of
bytes whatever the size of a group.

With 64 coordinates and 35 agreements a pair of similarity 0.8 is missed with
a probability below one in a hundred thousand; pairs above 0.8 less often.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import Columns, map_columns, mixed, stored, text_bytes, wide, windows, word_hashes
from tallyhouse.llm.components import components

COORDINATES, AGREE = 64, 35
#: Bytes of sets and signatures in one part of a tile, and documents in it.
PART_BYTES, PART_DOCUMENTS = 8 << 20, 1024
#: Rows of shingles that are turned into signatures at a time.
BLOCK = 1024

FEATURES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_id", T.BinaryType()),
        T.StructField("signature", T.ArrayType(T.LongType())),
    ]
)

LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def shingle_set(words: list[bytes], size: int, hashes) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than ``size`` are one shingle, none are none."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(words) < size:
        return mixed(windows(values, len(words)) + np.uint64(len(words)))
    return np.unique(windows(values, size))


@lru_cache(maxsize=4)
def factors(coordinates: int) -> np.ndarray:
    """Odd multipliers, one for each coordinate."""
    return mixed(np.arange(1, coordinates + 1, dtype=np.uint64)) | np.uint64(1)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Smallest value of each coordinate's hash over the set.

    All 64 bits are kept: the minimum of k shingles is one of about 2^64 / k values, so documents without a common shingle
    meet by chance in no coordinate, however many documents there are.
    """
    lowest = np.full(coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
    by = factors(coordinates)[:, None]
    for start in range(0, len(shingles), BLOCK):
        spread = shingles[None, start : start + BLOCK] * by
        spread ^= spread >> np.uint64(32)
        spread *= np.uint64(0x9E3779B97F4A7C15)
        np.minimum(lowest, spread.min(axis=1), out=lowest)
    return lowest


def features(documents: DataFrame, size: int, coordinates: int) -> DataFrame:
    """Set size, set digest and signature of each row's text."""

    def computed(batches: Iterator[Columns]) -> Iterator[Columns]:
        hashes = word_hashes()
        for batch in batches:
            out: Columns = {"doc_id": batch["doc_id"], "n_shingles": [], "set_id": [], "signature": []}
            for text in batch["text"]:
                shingles = shingle_set(text_bytes(text).lower().split(), size, hashes)
                out["n_shingles"].append(len(shingles))
                out["set_id"].append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                out["signature"].append(signature(shingles, coordinates).view(np.int64) if len(shingles) else None)
            yield out

    return map_columns(documents.select(F.col("doc_id").cast("long"), "text"), FEATURES, computed)


def families(sets: DataFrame, coordinates: int, agree: int) -> DataFrame:
    """``(id, root)`` of documents that share a value of their prefixes, from ``(id, signature)``."""
    token = F.posexplode("signature").alias("coordinate", "value")
    postings = sets.select("id", token).select("id", F.xxhash64("coordinate", "value").alias("token"))
    lists = stored(
        postings.groupBy("token").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1"), "posting-lists"
    )
    common = (
        postings.join(lists, "token")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("n", "token", "first"))).alias("lists"))
    )
    # Values of one document alone are the rarest and take up the prefix first.
    prefix = F.expr(f"slice(lists, 1, greatest(0, size(lists) - {agree - 1}))")
    ties = common.select("id", F.explode(F.array_distinct(F.transform(prefix, lambda x: x["first"]))).alias("first"))
    return components(ties.select(F.col("id").alias("a"), F.col("first").alias("b")))


def tiles(members: DataFrame, similarity: float) -> DataFrame:
    """``members (id, root, n)`` with the tiles in which each takes part, as ``tile`` and ``side``.

    Sizes fall in steps of the similarity, so a pair that can be linked lies in
    one step or in two neighbouring ones.
    """
    step = F.floor(F.log(F.col("n").cast("double")) / F.lit(-np.log(similarity))).cast("int")
    heavy = F.col("n") * 8 + 8 * COORDINATES
    members = members.withColumn("step", step).withColumn("bytes", heavy)
    whole = members.groupBy("root").agg(F.sum("bytes").alias("all_bytes"), F.count("*").alias("all"))
    by_step = members.groupBy("root", "step").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("documents"))
    parts = F.greatest(F.ceil(F.col("bytes") / PART_BYTES), F.ceil(F.col("documents") / PART_DOCUMENTS)).cast("int")
    small = (F.col("all_bytes") <= PART_BYTES // 16) & (F.col("all") <= PART_DOCUMENTS // 16)
    by_step = by_step.join(whole, "root").select("root", "step", parts.alias("parts"), small.alias("small"))
    above = by_step.select("root", (F.col("step") - 1).alias("step"), F.col("parts").alias("above"))
    below = by_step.select("root", (F.col("step") + 1).alias("step"), F.col("parts").alias("below"))
    keys = ["root", "step"]
    layout = stored(by_step.join(above, keys, "left").join(below, keys, "left").fillna(0, ["above", "below"]), "tile-layout")
    own = F.pmod(F.xxhash64(F.col("id"), F.lit(7)), F.col("parts"))
    # A tile is named by its family, the lower step, and a part of each side.
    same = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1),
        lambda p: F.struct(F.col("step").alias("step"), F.least("own", p).alias("one"), F.greatest("own", p).alias("other"), F.lit(0).alias("kind")),
    )
    up = F.transform(
        F.when(F.col("above") > 0, F.sequence(F.lit(0).cast("long"), F.col("above").cast("long") - 1)).otherwise(F.array().cast("array<bigint>")),
        lambda p: F.struct(F.col("step").alias("step"), F.col("own").alias("one"), p.alias("other"), F.lit(1).alias("kind")),
    )
    down = F.transform(
        F.when(F.col("below") > 0, F.sequence(F.lit(0).cast("long"), F.col("below").cast("long") - 1)).otherwise(F.array().cast("array<bigint>")),
        lambda p: F.struct((F.col("step") - 1).alias("step"), p.alias("one"), F.col("own").alias("other"), F.lit(1).alias("kind")),
    )
    placed = members.join(layout, keys).withColumn("own", own)
    large = (
        placed.where("not small")
        .select("id", "root", F.explode(F.concat(same, up, down)).alias("t"))
        .select("id", F.xxhash64("root", "t.step", "t.one", "t.other", "t.kind").alias("tile"))
        .distinct()
    )
    # Small families share a tile; the count of tiles follows the bytes and the documents.
    total = members.agg(F.sum("bytes"), F.count("*")).first()
    shared_tiles = 1 + max((total[0] or 0) // PART_BYTES, total[1] // (PART_DOCUMENTS // 4))
    bins = F.pmod(F.xxhash64("root"), F.lit(shared_tiles))
    shared = placed.where("small").select("id", bins.alias("tile"))
    return large.unionByName(shared)


class Forest:
    """Union-find over the rows of a tile."""

    def __init__(self, count: int):
        self.parent = list(range(count))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(len(self.parent))])

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def overlap(one: np.ndarray, other: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(one) > len(other):
        one, other = other, one
    at = np.searchsorted(other, one)
    at[at == len(other)] = 0
    return int((other[at] == one).sum())


def links_of_tile(sets: list[np.ndarray], percent: int, coordinates: int, agree: int) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs of ``sets``: pairs of positions."""
    count = len(sets)
    signatures = np.array([signature(s, coordinates) for s in sets], dtype=np.uint64).reshape(count, coordinates)
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(signatures, axis=0, kind="stable")
    ranked = np.take_along_axis(signatures, order, axis=0)
    # Posting list of each (row, coordinate): from begin to end in that coordinate's order.
    begin, end = np.empty((count, coordinates), dtype=np.int64), np.empty((count, coordinates), dtype=np.int64)
    for c in range(coordinates):
        edges = np.flatnonzero(np.r_[True, ranked[1:, c] != ranked[:-1, c], True])
        group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        begin[order[:, c], c], end[order[:, c], c] = edges[group], edges[group + 1]
    length = end - begin
    forest, found = Forest(count), []
    for row in range(count):
        by_length = np.argsort(length[row], kind="stable")
        short, long = by_length[: coordinates - agree + 1], by_length[coordinates - agree + 1 :]
        short = short[length[row, short] > 1]
        if not len(short):
            continue
        met = np.concatenate([order[begin[row, c] : end[row, c], c] for c in short])
        met = met[met > row]
        if not len(met):
            continue
        hits = np.bincount(met, minlength=count)
        others = np.flatnonzero(hits)
        # What the long lists can add is known without merging them.
        others = others[hits[others] + len(long) >= agree]
        total = hits[others] + (signatures[np.ix_(others, long)] == signatures[row, long]).sum(axis=1)
        fits = (total >= agree) & (100 * np.minimum(sizes[others], sizes[row]) >= percent * np.maximum(sizes[others], sizes[row]))
        others, total = others[fits], total[fits]
        for other in others[np.argsort(-total, kind="stable")]:
            if forest.root(row) == forest.root(other):
                continue
            shared = overlap(sets[row], sets[other])
            if 100 * shared >= percent * (len(sets[row]) + len(sets[other]) - shared):
                forest.join(row, int(other))
                found.append((row, int(other)))
    return found


def confirmed_links(documents: DataFrame, size: int, percent: int, coordinates: int, agree: int, partitions: int) -> DataFrame:
    """Links ``(a, b)`` found in each tile of ``documents (tile, id, text)``."""

    def searched(batches: Iterator[Columns]) -> Iterator[Columns]:
        hashes = word_hashes()
        tile, ids, sets = None, [], []

        def links() -> Columns:
            pairs = links_of_tile(sets, percent, coordinates, agree) if len(sets) > 1 else []
            return {"a": [ids[x] for x, _ in pairs], "b": [ids[y] for _, y in pairs]}

        for batch in batches:
            for row_tile, row_id, text in zip(batch["tile"], batch["id"], batch["text"]):
                if row_tile != tile:
                    yield links()
                    tile, ids, sets = row_tile, [], []
                ids.append(row_id)
                sets.append(shingle_set(text_bytes(text).lower().split(), size, hashes))
        yield links()

    dealt = documents.repartition(partitions, "tile").sortWithinPartitions("tile")
    return map_columns(dealt.select("tile", "id", "text"), LINK, searched)


def near_duplicates(
    documents: DataFrame, size: int = 5, percent: int = 80, coordinates: int = COORDINATES, agree: int = AGREE
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``documents``.

    ``percent`` is the similarity, of 100, from which two sets are linked;
    ``component_id`` is the smallest doc_id reachable over links, the row's own
    included, and ``kept`` tells whether it is the row's own.

    A text with fewer words than ``size`` has one shingle, all its words; without words,
    or null, it has none and is linked with nothing. Rows that repeat a doc_id
    count as one document with several texts: all of them get the same component.
    A null doc_id keeps a null component and is kept. A text of any length is shingled whole. Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """
    known = stored(features(documents, size, coordinates), "near-duplicate-features")
    with_set = known.where("set_id is not null and doc_id is not null")
    sets = stored(
        with_set.groupBy("set_id").agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n"), F.count("*").alias("copies")),
        "near-duplicate-sets",
    )
    roots = families(sets.select("id", "signature"), coordinates, agree)
    members = stored(roots.join(sets.select("id", "n"), "id"), "near-duplicate-members")
    in_tiles = tiles(members, percent / 100)
    # Texts are read again for members of families only, one of each set of copies.
    chosen = documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "text")
    texts = chosen.join(in_tiles.distinct().hint("shuffle_hash"), "id")
    links = confirmed_links(texts, size, percent, coordinates, agree, wide(documents.sparkSession))
    copies = with_set.join(sets.where("copies > 1").select("set_id", "id"), "set_id").select(
        F.col("doc_id").alias("a"), F.col("id").alias("b")
    )
    roots = components(links.unionByName(copies))
    found = known.join(roots, known["doc_id"] == roots["id"], "left")
    component = F.coalesce("root", "doc_id")
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
