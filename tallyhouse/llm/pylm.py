"""A hierarchical Pitman-Yor language model, sampled block by block.

Restaurants. A token's context is the token before it, then that token's last two bytes, then
its last byte, then nothing. Every previous token is a restaurant whose parent is that of its last two
bytes, whose parent is that of the last byte; all of those share the root, whose base is uniform over the
known tokens and one unknown. The leaves grow with the corpus; the restaurants above them have a fixed
bound, and their totals are shared with all tasks.

Blocks. Words are dealt to blocks by hash. A block holds all dishes of its words in all
restaurants, so a word's whole hierarchy is local to it. Totals of leaves are never shared as a whole:
each block sums up its own dishes by leaf, the sums go to parts of the leaves by hash and come back
added up for the leaves that the block knows. A leaf sends one number for each block at most, so none is hot.
Blocks also hold the dishes of texts that are only scored, without customers.

Files. Texts are read once. Each stretch of documents sends a block its dishes and, for every token, its
document. The block merges the dishes and writes two files to the shared folder: its dishes, and for each
stretch the numbers of the dishes that occur there with their documents. From then on only seatings and totals
move between tasks.

Sampling. One step draws the seating of each dish anew, given the tables of all other dishes and the
parents' predictive probabilities, from the leaves to the root; a dish's customers at a
parent are its tables below. Customers sit down one after the other, as in
the Chinese restaurant process. Tables of few customers are drawn from their exact distribution,
by generalised Stirling numbers. For more customers, how many find a place before the next table is
opened is a beta-geometric number, so a dish takes one draw for each of its tables, not
of its customers; where tables are opened often, a row of customers is seated together. Of several such seatings one is chosen by its importance weight, which
makes up for the order of sitting down. Between exchanges a block sees the other
blocks' tables as they were at the last exchange.

Scoring. A block scores each of its dishes once, over all samples, and adds the scores up by document and
stretch; tasks of several blocks send one sum for a document. Probabilities are averaged over the samples.

Words are known by 64-bit hashes; among a billion different words the chance of
any collision is below three in a hundred.
"""

from __future__ import annotations

import heapq
import pickle
import struct
import uuid
from collections.abc import Iterator
from copy import copy
from dataclasses import dataclass
from functools import lru_cache
from tempfile import SpooledTemporaryFile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyhouse.llm import files
from tallyhouse.llm.common import Columns, map_columns, new_folder, pieces, shuffles_removed, stored, wide

END = b"\n"
#: Tokens and documents of one stretch.
STRETCH_TOKENS, STRETCH_DOCUMENTS = 2_000_000, 60_000
#: Dishes that a block gathers before it merges equal ones.
MERGE = 800_000
#: Token before the first one of a text.
START = np.uint64(xxhash.xxh3_64_intdigest(b""))
#: Bits of a context's end, last byte first, that each level above the leaves leaves out, from there to the root.
ABOVE = (0, 8, 16)
#: Restaurants of each level whose totals are shared, from the leaves on; of the leaves only the sum over all.
SHARED = (1, *(1 << (16 - bits) for bits in ABOVE))
DEPTH = len(SHARED)
#: What precedes a stretch in a block's file: its number, its documents, the bytes that follow.
HEAD = "<qIQ"
STRENGTH = (1.0, 1.0, 1.0, 1.0)
#: Steps before the first sample, and samples; blocks exchange totals in between.
BURN_IN, SAMPLES = 2, 2
PROPOSALS = 3
#: Customers of a dish up to which its tables are drawn from their exact distribution.
EXACT = 1024
#: Numbers that this takes at a time.
CELLS = 1 << 20
#: Customers who are seated together, at most; dishes at a time below which this is also done where they open few tables.
ROW, FEW = 8192, 256
#: Blocks for each shuffle partition; a task holds one at a time.
BLOCKS_OF_PARTITION = 2
#: Blocks whose scores one task adds up; of each it then holds only the scores.
SCORED_TOGETHER = 4
#: Training tokens for each part of the leaves, so that blocks and parts don't exchange many small rows.
PART_TOKENS = 1 << 21
#: Training tokens of such blocks above which their stretches are dealt to several tasks.
TASK_TOKENS = 1 << 27
#: Bytes of a block's stretches that are kept in memory while its dishes are merged.
SPOOL_BYTES = 32 << 20

COUNTS = T.StructType(
    [
        T.StructField("block", T.IntegerType(), False),
        T.StructField("stretch", T.LongType(), False),
        T.StructField("n_documents", T.IntegerType(), False),
        T.StructField("dishes", T.BinaryType()),
        T.StructField("documents", T.BinaryType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("n_tokens", T.ArrayType(T.LongType())),
    ]
)
BLOCKS = T.StructType(
    [
        T.StructField("block", T.IntegerType(), False),
        T.StructField("words", T.LongType()),
        T.StructField("tokens", T.LongType()),
        T.StructField("dishes", T.StringType()),
        T.StructField("tables", T.ArrayType(T.BinaryType())),
        T.StructField("totals", T.ArrayType(T.BinaryType())),
    ]
)
#: A row for each block, and one of a negative block for each stretch.
READ = T.StructType([*BLOCKS.fields, *(f for f in COUNTS.fields if f.name in ("stretch", "doc_ids", "n_tokens"))])
ANSWERS = T.StructType(
    [
        T.StructField("part", T.IntegerType(), False),
        T.StructField("block", T.IntegerType(), False),
        T.StructField("sums", T.BinaryType(), False),
    ]
)
QUESTIONS = T.StructType([*ANSWERS.fields, T.StructField("leaves", T.BinaryType(), False)])
SUMS = T.StructType(
    [T.StructField("stretch", T.LongType(), False), T.StructField("sums", T.BinaryType())]
    + [f for f in COUNTS.fields if f.name in ("doc_ids", "n_tokens")]
)
SCORES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType(), False),
        T.StructField("n_known", T.LongType(), False),
        T.StructField("base_score", T.DoubleType(), False),
        T.StructField("score", T.DoubleType(), False),
    ]
)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from zero on, in few bytes; ``unpacked`` gives them back."""
    parts = [struct.pack("<I", len(arrays))]
    for a in arrays:
        top = int(a.max()) if len(a) else 0
        size = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
        planes = a.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T
        parts += [struct.pack("<BQ", size, len(a)), planes.tobytes()]
    data = b"".join(parts)
    return struct.pack("<Q", len(data)) + pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    (size,) = struct.unpack_from("<Q", data)
    data = pa.decompress(memoryview(data)[8:], decompressed_size=size, codec="zstd", asbytes=True)
    (many,), at, found = struct.unpack_from("<I", data), 4, []
    for _ in range(many):
        size, n = struct.unpack_from("<BQ", data, at)
        planes = np.frombuffer(data, dtype=np.uint8, count=size * n, offset=at + 9).reshape(size, n)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{size}"))
        at += 9 + size * n
    return found


def steps_of(a: np.ndarray) -> np.ndarray:
    """Differences of neighbours, the first from zero, as unsigned numbers that wrap; ``np.cumsum`` undoes it."""
    return np.diff(a.astype(np.uint64), prepend=np.uint64(0))


def swapped(ends: np.ndarray) -> np.ndarray:
    """Two-byte ends with the last byte first, so that those of one last byte are neighbours."""
    ends = ends.astype(np.int64)
    return (ends & 0xFF) << 8 | ends >> 8


@dataclass
class Pairs:
    """Counts of (word, previous token) pairs by number of their word and leaf, ascending."""

    words: np.ndarray  # uint64: different words, ascending
    leaves: np.ndarray  # uint64: different previous tokens, by their end from the last byte on, then by hash
    ends: np.ndarray  # last two bytes of the previous tokens
    key: np.ndarray  # int64: number of the word times the count of leaves, plus the leaf's number
    count: np.ndarray  # int64

    def packed(self) -> bytes:
        return packed(steps_of(self.words), steps_of(self.leaves), self.ends, steps_of(self.key), self.count)

    @classmethod
    def unpacked(cls, data: bytes) -> Pairs:
        words, leaves, ends, key, count = unpacked(data)
        words, leaves, key = (np.cumsum(a, dtype=np.uint64) for a in (words, leaves, key))
        return cls(words, leaves, ends, key.astype(np.int64), count.astype(np.int64))

    def split(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pairs' words and leaves."""
        return np.divmod(self.key, max(1, len(self.leaves)))

    def keys_of(self, other: Pairs) -> np.ndarray:
        """Keys of another one's pairs, ascending, all of whose words and leaves are known here."""
        by_hash = np.argsort(self.leaves)
        leaf = by_hash[np.searchsorted(self.leaves, other.leaves, sorter=by_hash)]
        own = other.split()
        return np.searchsorted(self.words, other.words)[own[0]] * len(self.leaves) + leaf[own[1]]

    @classmethod
    def merged(cls, many: list[Pairs]) -> Pairs:
        words = np.unique(np.concatenate([p.words for p in many]))
        leaves, first = np.unique(np.concatenate([p.leaves for p in many]), return_index=True)
        ends = np.concatenate([p.ends for p in many])[first]
        order = np.lexsort((leaves, swapped(ends)))
        one = cls(words, leaves[order], ends[order], np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
        key = np.concatenate([one.keys_of(p) for p in many])
        order = np.argsort(key, kind="stable")
        key = key[order]
        start = starts(key)
        one.key, one.count = key[start], np.add.reduceat(np.concatenate([p.count for p in many])[order], start) if len(start) else one.count
        return one


def starts(ascending: np.ndarray) -> np.ndarray:
    """Where each value begins."""
    return np.flatnonzero(np.diff(ascending, prepend=ascending[:1] - 1))


@dataclass
class Dishes:
    """Counts of (word, previous token) pairs, sorted by both."""

    words: np.ndarray  # uint64: different words, ascending
    word: np.ndarray  # int64: each pair's place in ``words``
    context: np.ndarray  # uint16: last two bytes of the previous token
    count: np.ndarray  # uint32
    previous: np.ndarray | None = None  # uint64: hash of the previous token; without it, one that occurs nowhere

    def __post_init__(self):
        if self.previous is None:
            self.previous = np.zeros(len(self.word), dtype=np.uint64)

    @classmethod
    def merged(cls, words: np.ndarray, context: np.ndarray, count: np.ndarray, previous: np.ndarray | None = None) -> Dishes:
        """From one word hash, context and count for each pair, with repetitions."""
        if previous is None:
            previous = context.astype(np.uint64)
        distinct, word = np.unique(words, return_inverse=True)
        leaves, first = np.unique(previous, return_index=True)
        ends = context[first]
        order = np.lexsort((leaves, swapped(ends)))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        key, where = np.unique(word * len(leaves) + place[np.searchsorted(leaves, previous)], return_inverse=True)
        total = np.bincount(where, weights=count, minlength=len(key)).astype(np.int64)
        return cls.of(Pairs(distinct, leaves[order], ends[order], key, total))

    @classmethod
    def of(cls, pairs: Pairs) -> Dishes:
        word, leaf = pairs.split()
        return cls(pairs.words, word, pairs.ends[leaf].astype(np.uint16), pairs.count.astype(np.uint32), pairs.leaves[leaf])

    def packed(self) -> bytes:
        leaves, first = np.unique(self.previous, return_index=True)
        order = np.lexsort((leaves, swapped(self.context[first])))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        key = self.word * len(leaves) + place[np.searchsorted(leaves, self.previous)]
        return Pairs(self.words, leaves[order], self.context[first][order], key, self.count).packed()

    @classmethod
    def unpacked(cls, data: bytes) -> Dishes:
        return cls.of(Pairs.unpacked(data))


class Stretch:
    """Tokens of consecutive documents, by numbers of their words."""

    def __init__(self):
        self.words: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.documents: list[int | None] = []
        self.learn: list[bool] = []
        self.tokens = 0

    def add(self, documents: list[int | None], learn: list[bool], words: pa.Array, lengths: np.ndarray) -> None:
        """Documents with all their words in a row, and the number of words of each."""
        self.documents += documents
        self.learn += learn
        self.words.append(words)
        self.lengths.append(lengths)
        self.tokens += len(words) + len(documents)

    def full(self) -> bool:
        return self.tokens >= STRETCH_TOKENS or len(self.documents) >= STRETCH_DOCUMENTS

    def sizes(self) -> np.ndarray:
        """Tokens of each document."""
        return np.concatenate(self.lengths) + 1

    def pairs(self) -> tuple[np.ndarray, ...]:
        """Word hashes and ends, the last for what is before a text; word number, number of the word before and weight of each token."""
        coded = pa.concat_arrays(self.words).dictionary_encode()
        words = [*coded.dictionary.cast(pa.large_binary()).to_pylist(), END]
        n = len(words)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
        ends = np.fromiter((int.from_bytes(w[-2:], "big") for w in words), dtype=np.uint16, count=n)
        sizes = self.sizes()
        last = np.cumsum(sizes) - 1
        ids = np.full(self.tokens, n - 1, dtype=np.int64)
        inner = np.ones(self.tokens, dtype=bool)
        inner[last] = False
        ids[inner] = coded.indices.to_numpy(zero_copy_only=False)
        before = np.empty(len(ids), dtype=np.int64)
        before[1:] = ids[:-1]
        before[last + 1 - sizes] = n
        weights = np.repeat(np.array(self.learn, dtype=bool), sizes)
        return np.append(hashes, START), np.append(ends, np.uint16(0)), ids, before, weights


def stretches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Stretch]:
    """Stretches of rows of ``doc_id, text, learn``."""
    stretch = Stretch()
    for batch in (piece for batch in batches for piece in pieces(batch)):
        # Taken rows are a copy of their own: pyarrow 23 has lower-cased slices of large strings at wrong offsets.
        texts = batch.column("text").take(np.arange(batch.num_rows))
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words = pc.list_flatten(split)
        # White space at either end of a text splits off an empty word.
        there = pc.greater(pc.binary_length(words), 0)
        words = words.filter(there)
        of = pc.list_parent_indices(split).filter(there).to_numpy(zero_copy_only=False)
        lengths = np.bincount(of, minlength=batch.num_rows)
        documents, learn = batch.column("doc_id").to_pylist(), batch.column("learn").to_pylist()
        ends = np.cumsum(lengths)
        row = 0
        while row < batch.num_rows:
            done = int(ends[row] - lengths[row])
            tokens = ends[row:] - done + np.arange(1, batch.num_rows - row + 1)
            many = int(np.searchsorted(tokens, STRETCH_TOKENS - stretch.tokens)) + 1
            many = min(many, STRETCH_DOCUMENTS - len(stretch.documents), batch.num_rows - row)
            own = slice(row, row + many)
            stretch.add(documents[own], learn[own], words[done : int(ends[row + many - 1])], lengths[own])
            row += many
            if stretch.full():
                yield stretch
                stretch = Stretch()
    if stretch.tokens:
        yield stretch


def block_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> np.uint64(33)) % np.uint64(blocks)).astype(np.int64)


def by_block(
    hashes: np.ndarray, ends: np.ndarray, ids: np.ndarray, before: np.ndarray, weights: np.ndarray, blocks: int
) -> Iterator[tuple[int, Pairs, np.ndarray, np.ndarray]]:
    """For each block its dishes, the number of tokens of each, and the tokens in order of the dishes."""
    block = block_of(hashes[:-1], blocks)
    order_of_words = np.lexsort((hashes[:-1], block))
    place = np.empty(len(order_of_words), dtype=np.int64)
    place[order_of_words] = np.arange(len(order_of_words))
    order_of_leaves = np.lexsort((hashes, swapped(ends)))
    leaf = np.empty(len(hashes), dtype=np.int64)
    leaf[order_of_leaves] = np.arange(len(hashes))
    key = place[ids] * len(hashes) + leaf[before]
    order = np.argsort(key)
    key = key[order]
    start = starts(key)
    word, which = np.divmod(key[start], len(hashes))
    served = np.add.reduceat(weights[order], start, dtype=np.int64)
    each = np.diff(np.append(start, len(order)))
    words, leaves, ends = hashes[order_of_words], hashes[order_of_leaves], ends[order_of_leaves]
    edges = np.searchsorted(block[order_of_words], np.arange(blocks + 1))
    pair_edges = np.searchsorted(word, edges)
    token_edges = np.append(start, len(order))[pair_edges]
    for b in range(blocks):
        if edges[b] < edges[b + 1]:
            pairs = slice(pair_edges[b], pair_edges[b + 1])
            known = np.zeros(len(leaves), dtype=bool)
            known[which[pairs]] = True
            own = np.flatnonzero(known)
            key = (word[pairs] - edges[b]) * len(own) + (np.cumsum(known) - 1)[which[pairs]]
            yield b, Pairs(words[edges[b] : edges[b + 1]], leaves[own], ends[own], key, served[pairs]), each[pairs], order[token_edges[b] : token_edges[b + 1]]


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers, by Stirling's series from x + 6 on."""
    shift = np.log(x * (x + 1) * (x + 2)) + np.log((x + 3) * (x + 4) * (x + 5))
    y = x + 6
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


@lru_cache(maxsize=DEPTH)
def log_ways(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: at [n, t - 1] the sum over all ways to seat n customers at t tables."""
    found = np.full((EXACT + 1, EXACT), -np.inf)
    found[1, 0] = 0.0
    for n in range(2, EXACT + 1):
        t = np.arange(1, n)
        found[n, : n - 1] = found[n - 1, : n - 1] + np.log(n - 1 - discount * t)
        found[n, 1:n] = np.logaddexp(found[n, 1:n], found[n - 1, : n - 1])
    return found


def seated_exactly(customers: np.ndarray, discount: float, strength: float, others: np.ndarray, base: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes of at most ``EXACT`` customers, drawn from their distribution given all else.

    The probability of t tables goes with the generalised Stirling number, which sums up the
    ways to seat the customers, times the weights of opening each further table.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    several = np.flatnonzero((customers > 1) & (customers <= EXACT))
    several = several[np.argsort(customers[several], kind="stable")]
    ways, at = log_ways(discount), 0
    while at < len(several):
        # Dishes of about as many customers, and not too many numbers at a time.
        n = customers[several[at]]
        until = np.searchsorted(customers[several], max(n, n * 9 // 8), side="right")
        here = several[at : min(until, at + max(1, CELLS // int(n)))]
        at += len(here)
        most = customers[here[-1]]
        weight = ways[customers[here], :most]
        weight[:, 1:] += np.cumsum(np.log((strength + discount * (others[here, None] + np.arange(1, most))) * base[here, None]), axis=1)
        sums = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
        drawn = rng.random(len(here)) * sums[:, -1]
        tables[here] = np.minimum(1 + (sums <= drawn[:, None]).sum(axis=1), customers[here])
    return tables


def rows_seated(
    sitting: np.ndarray, opened: np.ndarray, row: np.ndarray, share: np.ndarray, discount: float, strength: float, others: np.ndarray, base: np.ndarray, rng: np.random.Generator
) -> tuple[np.ndarray, np.ndarray]:
    """Tables that the next ``row`` customers of each dish open, and the log of the seating's importance weight.

    They choose as if tables grew steadily; the weight makes up for it by the tables there really are.
    """
    first = np.cumsum(row) - row
    ahead = np.arange(row.sum()) - np.repeat(first, row)
    j, t, share, others, base = (np.repeat(a, row) for a in (sitting, opened, share, others, base))
    j = j + ahead

    def choices(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (strength + discount * (others + t)) * base, j - discount * t

    new, old = choices(t + share * ahead)
    chance = new / (new + old)
    opens = rng.random(len(j)) < chance
    before = np.cumsum(opens) - opens
    new, old = choices(t + before - np.repeat(before[first], row))
    weight = np.log(np.where(opens, new / chance, old / (1 - chance)))
    return np.add.reduceat(opens, first, dtype=np.int64), np.add.reduceat(weight, first)


def seated(
    customers: np.ndarray, discount: float, strength: float, others: np.ndarray, base: np.ndarray, rng: np.random.Generator
) -> np.ndarray:
    """Tables of each dish after its customers have sat down one by one.

    ``others`` are the tables of other dishes in its restaurant, ``base`` its
    probability at the parent.
    """
    tables = seated_exactly(customers, discount, strength, others, base, rng)
    several = np.flatnonzero(customers > EXACT)
    if not len(several):
        return tables
    n = np.tile(customers[several].astype(np.int64), PROPOSALS)
    others, base = np.tile(others[several].astype(np.float64), PROPOSALS), np.tile(base[several], PROPOSALS)
    sitting, opened, weight = np.ones(len(n), dtype=np.int64), np.ones(len(n)), np.zeros(len(n))
    active = np.arange(len(n))
    while len(active):
        j, t = sitting[active], opened[active]
        new = (strength + discount * (others[active] + t)) * base[active]
        old = j - discount * t
        row = np.minimum(np.clip(j // 8, 1, ROW), n[active] - j)
        share = new / (new + old)
        dense = (row * share > 4) & ((share > 0.2) | (len(active) <= FEW))
        if dense.any():
            at = active[dense]
            tables_of, weight_of = rows_seated(j[dense], t[dense], row[dense], share[dense], discount, strength, others[at], base[at], rng)
            sitting[at] += row[dense]
            opened[at] += tables_of
            weight[at] += weight_of
        if not dense.all():
            one = ~dense
            who, j, t, new, old = active[one], j[one], t[one], new[one], old[one]
            chance = np.clip(rng.beta(new, old), 1e-15, 1.0)
            at = np.minimum(j + rng.geometric(chance), n[who] + 1)
            until = np.minimum(at, n[who])
            # Customers j .. until-1 met a choice of this weight in all.
            weight[who] += log_gamma(until - discount * t + new) - log_gamma(old + new)
            sitting[who] = until
            opened[who[at <= n[who]]] += 1
        active = active[sitting[active] < n[active]]
    weight = weight.reshape(PROPOSALS, -1)
    noise = rng.gumbel(size=weight.shape)
    chosen = np.argmax(weight + noise, axis=0)
    tables[several] = opened.reshape(PROPOSALS, -1)[chosen, np.arange(len(several))].astype(np.int64)
    return tables


@dataclass
class Totals:
    """Customers and tables of every restaurant at each level, and what the model holds fixed.

    Shared totals have one sum over all leaves; ``at_leaves`` puts those of a block's leaves in its place.
    """

    customers: list[np.ndarray]
    tables: list[np.ndarray]
    discounts: tuple[float, ...]
    base: float

    def at_leaves(self, customers: np.ndarray, tables: np.ndarray) -> Totals:
        """A copy with these totals of leaves."""
        others = [[a.copy() for a in kind[1:]] for kind in (self.customers, self.tables)]
        return Totals([customers, *others[0]], [tables, *others[1]], self.discounts, self.base)

    def predictive(self, level: int, context: np.ndarray, customers, tables, parent) -> np.ndarray:
        """Probability of dishes with these customers and tables, given that at the parent."""
        d, s = self.discounts[level], STRENGTH[level]
        all_c, all_t = self.customers[level][context], self.tables[level][context]
        return (customers - d * tables + (s + d * all_t) * parent) / (s + all_c)


def read(address: str) -> bytes:
    with files.reader(*address.rsplit("/", 1)) as file:
        return file.read()


class Block:
    """A block's dishes at every level, with their customers and tables."""

    def __init__(self, data: bytes | str, tables: list[bytes] | None = None):
        """``data`` are packed pairs or the address of a file of them; without ``tables`` each dish has one, if it has customers."""
        pairs = Pairs.unpacked(read(data) if isinstance(data, str) else data)
        self.words, self.leaves, self.served = pairs.words, pairs.leaves, pairs.count
        self.word, leaf = pairs.split()
        # Leaves are ordered by their ends, so the keys ascend at every level.
        below = (self.word << 16) | swapped(pairs.ends)[leaf]
        self.keys, self.up, self.contexts = [pairs.key], [], [leaf.astype(np.int32)]
        for bits in ABOVE:
            key = below >> bits << bits
            first = starts(key)
            new = np.zeros(len(key), dtype=np.int32)
            new[first[1:]] = 1
            self.up.append(np.cumsum(new, dtype=np.int32))
            below = key[first]
            self.keys.append(below)
            self.contexts.append(((below & 0xFFFF) >> bits).astype(np.int32))
        self.word = self.word.astype(np.int32)
        self.customers: list[np.ndarray] = []
        self.tables: list[np.ndarray] = []
        self._take(tables)

    def _take(self, tables: list[bytes] | None) -> None:
        self.customers, self.tables = [self.served], []
        for level in range(DEPTH):
            if level:
                above = np.bincount(self.up[level - 1], weights=self.tables[-1], minlength=len(self.keys[level]))
                self.customers.append(above.astype(np.int64))
            self.tables.append(np.minimum(self.customers[level], 1) if tables is None else unpacked(tables[level])[0].astype(np.int64))

    def with_tables(self, tables: list[bytes]) -> Block:
        """The same dishes with other tables."""
        other = copy(self)
        other._take(tables)
        return other

    def counts(self) -> np.ndarray:
        """Customers of each word in all."""
        return np.bincount(self.word, weights=self.served, minlength=len(self.words))

    def predictive(self, totals: Totals, lowest: int = 0) -> np.ndarray | float:
        """Probability of every dish at a level; that of the base above the root."""
        found: np.ndarray | float = totals.base
        for level in reversed(range(lowest, DEPTH)):
            parent = found[self.up[level]] if isinstance(found, np.ndarray) else found
            found = totals.predictive(level, self.contexts[level], self.customers[level], self.tables[level], parent)
        return found

    def step(self, totals: Totals, rng: np.random.Generator) -> None:
        """Draw all seatings anew, leaves first; the totals follow this block's changes."""
        for level in range(DEPTH):
            several = np.flatnonzero(self.customers[level] > 1)
            above = self.predictive(totals, level + 1)
            parent = above[self.up[level][several]] if isinstance(above, np.ndarray) else np.full(len(several), above)
            context, before = self.contexts[level][several], self.tables[level][several]
            size = len(totals.tables[level])
            others = np.maximum(totals.tables[level][context] - before, 0)
            drawn = seated(self.customers[level][several], totals.discounts[level], STRENGTH[level], others, parent, rng)
            # Dishes of one customer have one table, those of none have none.
            tables = np.minimum(self.customers[level], 1)
            tables[several] = drawn
            change = np.bincount(self.contexts[level], weights=tables - self.tables[level], minlength=size)
            self.tables[level] = tables
            totals.tables[level] = totals.tables[level] + change
            if level < DEPTH - 1:
                above = self.customers[level + 1]
                self.customers[level + 1] = np.bincount(self.up[level], weights=self.tables[level], minlength=len(above)).astype(np.int64)
                moved = np.bincount(self.contexts[level + 1], weights=self.customers[level + 1] - above, minlength=len(totals.customers[level + 1]))
                totals.customers[level + 1] = totals.customers[level + 1] + moved

    def own_totals(self) -> list[bytes]:
        """Customers and tables by context and level, and dishes of one and of two customers, for summing up."""
        found = []
        for level, size in enumerate(SHARED):
            for counts in (self.customers[level], self.tables[level]):
                total = np.bincount(self.contexts[level], weights=counts, minlength=size) if level else counts.sum(keepdims=True)
                found.append(packed(total.astype(np.int64)))
            found.append(packed(np.array([(self.customers[level] == k).sum() for k in (1, 2)])))
        return found

    def at_leaves(self, counts: np.ndarray) -> np.ndarray:
        """Sums of a number of each dish by leaf."""
        return np.bincount(self.contexts[0], weights=counts, minlength=len(self.leaves))

    def packed_tables(self) -> list[bytes]:
        return [packed(t) for t in self.tables]


def texts_read(documents: DataFrame, blocks: int, learn: Column | None = None) -> DataFrame:
    """Dishes of all texts, one row for each block, with one table for each dish of customers, and one for each stretch.

    Texts not to learn from give dishes without customers. A block's dishes, and which of them each
    stretch has in which documents, are in the file that the row names and in another of that name with ``-texts``.
    """

    schema = to_arrow_schema(COUNTS)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32

        def row(**values) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({c: [values.get(c)] for c in COUNTS.names}, schema=schema)

        for number, stretch in enumerate(stretches_of(batches), serial):
            n, sizes = len(stretch.documents), stretch.sizes()
            # A negative block: rows of stretches go to as many tasks.
            yield row(block=-1 - number % blocks, stretch=number, n_documents=n, doc_ids=stretch.documents, n_tokens=sizes.tolist())
            of_token = np.repeat(np.arange(n, dtype=np.uint16), sizes)
            for b, pairs, each, tokens in by_block(*stretch.pairs(), blocks):
                yield row(block=b, stretch=number, n_documents=n, dishes=pairs.packed(), documents=packed(each, of_token[tokens]))
        pa.default_memory_pool().release_unused()

    def blocks_of(batches: Iterator[Columns]) -> Iterator[Columns]:
        number, parts, held = None, [], 0
        spool = SpooledTemporaryFile(SPOOL_BYTES)

        def row() -> Columns:
            every = Pairs.merged(parts)
            name = f"{number}-{uuid.uuid4().hex}"
            with files.writer(folder, name) as out:
                out.write(every.packed())
            spool.seek(0)
            with files.writer(folder, f"{name}-texts") as out:
                for _ in range(stretches_held):
                    stretch, n, dishes, texts = pickle.load(spool)
                    at = np.searchsorted(every.key, every.keys_of(Pairs.unpacked(dishes)))
                    data = packed(steps_of(at), *unpacked(texts))
                    out.write(struct.pack(HEAD, stretch, n, len(data)))
                    out.write(data)
            block = Block(f"{folder}/{name}")
            return empty | {
                "block": [number],
                "words": [int((block.counts() > 0).sum())],
                "tokens": [int(block.served.sum())],
                "dishes": [f"{folder}/{name}"],
                "tables": [block.packed_tables()],
                "totals": [block.own_totals()],
            }

        empty, stretches_held = {f: [None] for f in READ.names} | {"stretch": [-1]}, 0
        for batch in batches:
            for b, stretch, n, dishes, texts, ids, lengths in zip(*(batch[c] for c in COUNTS.names)):
                if b < 0:
                    yield empty | {"block": [b], "stretch": [stretch], "doc_ids": [ids], "n_tokens": [lengths]}
                    continue
                if b != number:
                    if parts:
                        yield row()
                    number, parts, held, stretches_held = b, [], 0, 0
                    spool.close()
                    spool = SpooledTemporaryFile(SPOOL_BYTES)
                pickle.dump((stretch, n, dishes, texts), spool)
                stretches_held += 1
                parts.append(Pairs.unpacked(dishes))
                held += len(parts[-1].key)
                if held > MERGE and len(parts) > 1:
                    parts = [Pairs.merged(parts)]
                    held = len(parts[0].key) // 2
        if parts:
            yield row()
        spool.close()

    spark = documents.sparkSession
    folder = new_folder(spark, "language-model-files")
    learn = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    pairs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", learn.alias("learn")).mapInArrow(stretches, COUNTS)
    dealt = pairs.repartition(blocks, "block").sortWithinPartitions("block", "stretch")
    with shuffles_removed(spark):
        return stored(map_columns(dealt, READ, blocks_of), "language-model-counts")


def counted(documents: DataFrame, blocks: int, learn: Column | None = None) -> DataFrame:
    """The rows of blocks of ``texts_read``."""
    return texts_read(documents, blocks, learn).where("block >= 0").select(*BLOCKS.names)


def summed(blocks: DataFrame, samples: int = 1, discounts: tuple[float, ...] | None = None) -> tuple[list[Totals], int]:
    """Shared totals over all blocks for each sample, and the count of tokens; above the leaves restaurants are few, whatever the corpus."""

    sizes = [n for size in SHARED for n in (size, size, 2)] * samples + [2]

    def spread(batches: Iterator[Columns]) -> Iterator[Columns]:
        # One sum for all blocks of a task.
        found = [np.zeros(n) for n in sizes]
        for batch in batches:
            for totals, words, tokens in zip(batch["totals"], batch["words"], batch["tokens"]):
                found[-1] += (words, tokens)
                for k, data in enumerate(totals):
                    found[k] += unpacked(data)[0]
        for kind, numbers in enumerate(found):
            there = np.flatnonzero(numbers)
            yield {"kind": [kind] * len(there), "at": there.tolist(), "value": numbers[there].tolist()}

    schema = T.StructType(
        [T.StructField("kind", T.IntegerType()), T.StructField("at", T.IntegerType()), T.StructField("value", T.DoubleType())]
    )
    rows = map_columns(blocks.select("totals", "words", "tokens"), schema, spread).groupBy("kind", "at").agg(F.sum("value").alias("value"))
    found = [np.zeros(n) for n in sizes]
    for kind, at, value in rows.collect():
        found[kind][at] = value
    words, tokens = found[-1].astype(np.int64).tolist()
    if discounts is None:
        # The usual estimate from dishes of one and of two customers.
        discounts = tuple(float(np.clip((n[0] + 1) / (n[0] + 2 * n[1] + 2), 0.05, 0.95)) for n in found[2 : 3 * DEPTH : 3])
    each = [found[k : k + 3 * DEPTH] for k in range(0, 3 * DEPTH * samples, 3 * DEPTH)]
    return [Totals(one[0::3], one[1::3], discounts, 1 / (words + 1)) for one in each], tokens


def part_of(leaves: np.ndarray, parts: int) -> np.ndarray:
    """Parts ascend with the hashes."""
    return (((leaves >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def with_leaves(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``leaves``: for each part of a block's leaves, by hash, the customers and, for each sample, the tables over all blocks."""
    (tokens,) = blocks.agg(F.sum("tokens")).first()
    parts = int(min(max(1, (tokens or 0) // PART_TOKENS), wide(blocks.sparkSession)))

    def questions(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for number, data, tables in zip(batch["block"], batch["dishes"], batch["tables"]):
                pairs = Pairs.unpacked(read(data))
                order = np.argsort(pairs.leaves)
                leaves, leaf = pairs.leaves[order], pairs.split()[1]
                sums = [np.bincount(leaf, weights=n, minlength=len(order))[order] for n in (pairs.count, *(unpacked(t)[0] for t in tables[::DEPTH]))]
                edges = np.searchsorted(part_of(leaves, parts), np.arange(parts + 1))
                there = [(p, slice(edges[p], edges[p + 1])) for p in range(parts) if edges[p] < edges[p + 1]]
                yield {
                    "part": [p for p, _ in there],
                    "block": [number] * len(there),
                    "sums": [packed(*(a[own] for a in sums)) for _, own in there],
                    "leaves": [packed(steps_of(leaves[own])) for _, own in there],
                }

    def answers(batches: Iterator[Columns]) -> Iterator[Columns]:
        number, asked = None, []

        def rows() -> Columns:
            leaves = [np.cumsum(unpacked(data)[0], dtype=np.uint64) for _, data, _ in asked]
            place = np.unique(np.concatenate(leaves), return_inverse=True)[1]
            each = [unpacked(sums) for _, _, sums in asked]
            totals = [np.bincount(place, weights=np.concatenate(own)) for own in zip(*each)]
            edges = np.cumsum([0, *map(len, leaves)])
            back = [place[start:end] for start, end in zip(edges[:-1], edges[1:])]
            return {
                "part": [number] * len(asked),
                "block": [b for b, _, _ in asked],
                "sums": [packed(*(t[at] for t in totals)) for at in back],
            }

        for batch in batches:
            for p, *question in zip(*(batch[c] for c in ("part", "block", "leaves", "sums"))):
                if p != number:
                    if asked:
                        yield rows()
                    number, asked = p, []
                asked.append(question)
        if asked:
            yield rows()

    count = BLOCKS_OF_PARTITION * wide(blocks.sparkSession)
    dealt = blocks.repartition(count, "block")
    asked = map_columns(dealt.select("block", "dishes", "tables"), QUESTIONS, questions)
    found = map_columns(asked.repartition(parts, "part").sortWithinPartitions("part"), ANSWERS, answers)
    leaves = found.repartition(count, "block").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "sums"))).alias("leaves"))
    return dealt.join(leaves, "block")


def leaf_totals(block: Block, leaves: list[dict], samples: int) -> list[np.ndarray]:
    """Customers of a block's leaves, and their tables in each of its samples."""
    order = np.argsort(block.leaves)
    found = []
    for each in zip(*(unpacked(part["sums"]) for part in leaves)):
        found.append(np.empty(len(order)))
        found[-1][order] = np.concatenate(each)
    return found or [np.empty(0)] * (1 + samples)


def sampled(blocks: DataFrame, totals: Totals, steps: int, samples: int, seed: int) -> DataFrame:
    """Run steps on every block; keeps the tables of the last ``samples`` steps."""
    shared = blocks.sparkSession.sparkContext.broadcast(totals)

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for k, number in enumerate(batch["block"]):
                block = Block(batch["dishes"][k], batch["tables"][k][-DEPTH:])
                leaves = leaf_totals(block, batch["leaves"][k], 1)
                own = shared.value.at_leaves(leaves[0], leaves[-1])
                rng = np.random.default_rng([seed, number])
                tables: list[bytes] = []
                sums: list[bytes] = []
                for done in range(1, steps + 1):
                    block.step(own, rng)
                    if done > steps - samples:
                        tables += block.packed_tables()
                        sums += block.own_totals()
                yield {c: [batch[c][k]] for c in ("block", "words", "tokens", "dishes")} | {"tables": [tables], "totals": [sums]}

    with shuffles_removed(blocks.sparkSession):
        return stored(map_columns(with_leaves(blocks.drop("totals")), BLOCKS, run), "language-model-blocks")


def places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value lies in the ascending ``keys``, and whether it is there."""
    at = np.searchsorted(keys, wanted)
    there = at < len(keys)
    there[there] = keys[at[there]] == wanted[there]
    return at, there


class Model:
    """A block with several samples, ready to score dishes."""

    def __init__(self, data: bytes | str, tables: list[bytes], totals: list[Totals], tokens: int, leaves: list[dict] | None = None):
        """Without ``leaves`` the block is the only one."""
        first = Block(data, tables[:DEPTH])
        self.samples = [first] + [first.with_tables(tables[k : k + DEPTH]) for k in range(DEPTH, len(tables), DEPTH)]
        self.totals, self.tokens = [], tokens
        answers = None if leaves is None else leaf_totals(first, leaves, len(self.samples))
        for k, (block, shared) in enumerate(zip(self.samples, totals)):
            own = (block.at_leaves(block.customers[0]), block.at_leaves(block.tables[0])) if answers is None else (answers[0], answers[1 + k])
            self.totals.append(shared.at_leaves(*own))
        self.words, self.counts = first.words, first.counts()

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the base probability of words that occur so often."""
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * round(1 / self.totals[0].base)))

    def own(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each dish of the block: log10 of its mean probability, of its base probability, and whether the word is known."""
        mean = sum(block.predictive(totals) / len(self.samples) for block, totals in zip(self.samples, self.totals))
        word = self.samples[0].word
        return np.log10(mean), self.base(self.counts)[word], (self.counts > 0)[word]

    def score(self, asked: Dishes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for dishes that the block need not have."""
        block = self.samples[0]
        place, there = places(self.words, asked.words)
        counts = np.zeros(len(place))
        counts[there] = self.counts[place[there]]
        # An unknown word has a key that no dish has, and so has an unknown leaf; nobody sits there.
        word = np.where(there, place, -1)[asked.word]
        by_hash = np.argsort(block.leaves)
        leaf, there = places(block.leaves[by_hash], asked.previous)
        leaf = by_hash[np.where(there, leaf, 0)]
        end = swapped(asked.context)
        keys = [np.where(there & (word >= 0), word * len(block.leaves) + leaf, -1), *(((word << 16) | end) >> bits << bits for bits in ABOVE)]
        contexts = [leaf, *(end >> bits for bits in ABOVE)]
        mean = 0.0
        for block, totals in zip(self.samples, self.totals):
            probability: np.ndarray | float = totals.base
            for level in reversed(range(DEPTH)):
                at, found = places(block.keys[level], keys[level])
                customers, tables = np.zeros(len(at)), np.zeros(len(at))
                customers[found], tables[found] = block.customers[level][at[found]], block.tables[level][at[found]]
                if level or there.all():
                    probability = totals.predictive(level, contexts[level], customers, tables, probability)
                elif there.any():
                    probability[there] = totals.predictive(0, leaf[there], customers[there], tables[there], probability[there])
            mean = mean + probability / len(self.samples)
        return np.log10(mean), self.base(counts)[asked.word], (counts > 0)[asked.word]


def stretch_sums(number: int, address: str, scores: tuple[np.ndarray, ...], salt: int, salts: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """From a block's file: stretch, number of the block among its task's, and sums of the scores by document."""
    with files.reader(*f"{address}-texts".rsplit("/", 1)) as file:
        while head := file.read(struct.calcsize(HEAD)):
            stretch, n, size = struct.unpack(HEAD, head)
            if stretch % salts != salt:
                file.seek(size, 1)
                continue
            steps, each, document = unpacked(file.read(size))
            pair = np.repeat(np.cumsum(steps, dtype=np.uint64).astype(np.int64), each)
            yield stretch, number, np.array([np.bincount(document, weights=s[pair], minlength=n) for s in scores])


def scored(texts: DataFrame, blocks: DataFrame, totals: list[Totals], tokens: int, count: int) -> DataFrame:
    """``SCORES`` of every document, from the rows of stretches in ``texts`` and the sampled blocks."""
    session = texts.sparkSession
    together = F.col("block") % max(1, -(-count // SCORED_TOGETHER))
    large = blocks.groupBy(together.alias("task")).agg(F.sum("tokens").alias("n")).where(F.col("n") >= TASK_TOKENS).collect()
    salts = {t: 1 + n // TASK_TOKENS for t, n in large}
    shared = session.sparkContext.broadcast(totals)
    copies = F.lit(1)
    if salts:
        copies = F.coalesce(F.create_map(*[F.lit(x) for pair in salts.items() for x in pair])[F.col("task")], F.lit(1))
    asked = with_leaves(blocks.drop("totals")).select("block", "dishes", "tables", "leaves", together.alias("task"))
    asked = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), (copies - 1).cast("int"))))

    def answered(batches: Iterator[Columns]) -> Iterator[Columns]:
        def sums(here: tuple[int, int], models: list[tuple[str, tuple[np.ndarray, ...]]]) -> Iterator[Columns]:
            task, salt = here
            each = [stretch_sums(k, *model, salt, salts.get(task, 1)) for k, model in enumerate(models)]
            number, total = None, None
            for stretch, _, own in heapq.merge(*each, key=lambda x: x[:2]):
                if stretch != number:
                    if number is not None:
                        yield row(number, total)
                    number, total = stretch, 0.0
                total = total + own
            if number is not None:
                yield row(number, total)

        def row(stretch: int, total: np.ndarray) -> Columns:
            return {"stretch": [stretch], "sums": [total.astype("<f8").tobytes()], "doc_ids": [None], "n_tokens": [None]}

        before, models = None, []
        for batch in batches:
            for task, salt, dishes, tables, leaves in zip(*(batch[c] for c in ("task", "salt", "dishes", "tables", "leaves"))):
                if (task, salt) != before:
                    if models:
                        yield from sums(before, models)
                    before, models = (task, salt), []
                models.append((dishes, Model(dishes, tables, shared.value, tokens, leaves).own()))
        if models:
            yield from sums(before, models)

    def gathered(batches: Iterator[Columns]) -> Iterator[Columns]:
        number, sums, ids, lengths = None, 0.0, [], []

        def rows() -> Columns:
            score, base, known = np.reshape(sums, (3, -1)).tolist() if len(ids) else ([], [], [])
            return {"doc_id": ids, "n_tokens": lengths, "n_known": list(map(round, known)), "base_score": base, "score": score}

        for batch in batches:
            for stretch, part, doc_ids, n_tokens in zip(*(batch[c] for c in SUMS.names)):
                if stretch != number:
                    yield rows()
                    number, sums, ids, lengths = stretch, 0.0, [], []
                if part is not None:
                    sums = sums + np.frombuffer(part, dtype="<f8")
                if doc_ids is not None:
                    ids, lengths = doc_ids, n_tokens
        yield rows()

    dealt = asked.repartition(count, "task", "salt").sortWithinPartitions("task", "salt", "block")
    rest = texts.where("block < 0").select("stretch", F.lit(None).cast("binary").alias("sums"), "doc_ids", "n_tokens")
    sums = map_columns(dealt, SUMS, answered).unionByName(rest)
    back = sums.repartition(count, "stretch").sortWithinPartitions("stretch")
    return map_columns(back, SCORES, gathered)


def language_model_scores(documents: DataFrame, learn: Column, blocks: int | None = None, seed: int = 1) -> DataFrame:
    """Learn from the texts where ``learn`` holds, and score all texts.

    Returns ``doc_id, n_tokens, n_known, base_score, score`` and ``train_tokens``. Tokens are words
    between ASCII white space, A-Z in lower case, then one end. ``base_score`` is that of add-half
    counting, ``score`` the model's log10 probability of the text.

    A null or empty text is its end alone. Nothing to learn from leaves the uniform
    base. Repeated rows get results of their own; an empty table gives none. Texts
    are read whole; other columns are ignored.
    """
    count = blocks or BLOCKS_OF_PARTITION * wide(documents.sparkSession)
    texts = texts_read(documents, count, learn)
    counts = texts.where("block >= 0").select(*BLOCKS.names)
    (start,), tokens = summed(counts)
    burnt = sampled(counts, start, BURN_IN, 1, seed)
    (exchanged,), _ = summed(burnt, discounts=start.discounts)
    model = sampled(burnt, exchanged, SAMPLES, SAMPLES, seed + 1)
    totals, _ = summed(model, SAMPLES, start.discounts)
    return scored(texts, model, totals, tokens, count).withColumn("train_tokens", F.lit(tokens).cast("long"))


def perplexity(score: Column, tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -score / tokens)
