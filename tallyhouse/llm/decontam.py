"""Benchmark decontamination with one Aho-Corasick automaton.

Test items are normalised to words and cut into windows of consecutive words.
All windows are patterns of one automaton, which scans each normalised text once. An
occurrence gives its words; their places in the original text are known,
because normalising replaces single bytes and so moves nothing.

The automaton is built in each Python worker from the items' texts, which are
broadcast. Their size is checked: items beyond ``BLOCK_BYTES`` form further
blocks with automata of their own, and every text is scanned by each of them.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import Columns, map_columns, text_bytes

WINDOW = 10
#: Bytes of item texts in one automaton.
BLOCK_BYTES = 16 << 20

#: Letters and digits of ASCII in lower case, all bytes of other characters, and a space for the rest.
NORMAL = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("n_hit", T.LongType(), False),
        T.StructField("item_ids", T.ArrayType(T.LongType()), False),
        T.StructField("spans", T.ArrayType(SPAN), False),
    ]
)

Item = tuple[int, str]


def normal_words(text: str | None) -> list[bytes]:
    return text_bytes(text).translate(NORMAL).split()


def item_windows(words: list[bytes], window: int) -> list[list[bytes]]:
    """All windows of an item; the whole item if it is shorter; none without words."""
    if len(words) <= window:
        return [words] if words else []
    return [words[i : i + window] for i in range(len(words) - window + 1)]


class Windows:
    """The automaton over the windows of some items."""

    def __init__(self, items: list[Item], window: int):
        owners: dict[str, set[int]] = defaultdict(set)
        for item, text in items:
            for words in item_windows(normal_words(text), window):
                # One character for each byte; a space on both sides keeps to whole words.
                owners[b" ".join([b"", *words, b""]).decode("latin-1")].add(item)
        self.automaton = ahocorasick.Automaton()
        for pattern, ids in owners.items():
            self.automaton.add_word(pattern, (len(pattern), pattern.count(" ") - 1, tuple(ids)))
        self.empty = not owners
        self.automaton.make_automaton()

    def occurrences(self, line: str) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        """First character, words and items of each occurrence in a normalised line."""
        if not self.empty:
            for end, (length, words, ids) in self.automaton.iter(line):
                yield end + 1 - length, words, ids


_built: dict[tuple[str, int], Windows] = {}


def automaton(name: str, items: Broadcast, window: int) -> Windows:
    """The automaton of a block of items; a Python worker keeps the one it used last."""
    if (name, window) not in _built:
        _built.clear()
        _built[name, window] = Windows(items.value, window)
    return _built[name, window]


def blocks(items: DataFrame, block_bytes: int) -> list[Broadcast]:
    """Broadcasts of the items' ids and texts, each of bounded size."""
    context = items.sparkSession.sparkContext
    items = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = 1 + size // block_bytes
    if count == 1:
        return [context.broadcast([tuple(row) for row in items.collect()])]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [context.broadcast([tuple(row) for row in items.where(part == k).collect()]) for k in range(count)]


class Normal:
    """A text in normal form, with what was found in it."""

    def __init__(self, text: str | None):
        self.flat = text_bytes(text).translate(NORMAL)
        self.words = self.flat.split()
        self.items: set[int] = set()
        self.covered = np.zeros(0, dtype=bool)

    def scan(self, windows: Windows) -> None:
        line = b" ".join([b"", *self.words, b""]).decode("latin-1")
        found = list(windows.occurrences(line))
        if not found:
            return
        starts = np.cumsum([0] + [len(w) + 1 for w in self.words])
        first = np.searchsorted(starts, [start for start, _, _ in found])
        edges = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.add.at(edges, first, 1)
        np.add.at(edges, first + [words for _, words, _ in found], -1)
        covered = np.cumsum(edges[:-1]) > 0
        self.covered = covered | self.covered if len(self.covered) else covered
        self.items.update(item for _, _, ids in found for item in ids if item is not None)

    def spans(self) -> list[dict[str, int]]:
        """Covered stretches of the original text, in bytes."""
        if not len(self.covered):
            return []
        runs = np.flatnonzero(np.diff(np.r_[False, self.covered, False]))
        body = np.frombuffer(self.flat, dtype=np.uint8) != 32
        turns = np.flatnonzero(np.diff(np.r_[False, body, False]))
        begins, ends = turns[::2], turns[1::2]
        return [{"start": int(begins[a]), "stop": int(ends[b - 1])} for a, b in zip(runs[::2], runs[1::2])]


def find_items(
    documents: DataFrame, items: DataFrame, keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Which ``items (item_id, text)`` occur in each row's ``text``.

    Returns the ``keep`` columns, ``n_words``, ``n_hit`` (words inside an
    occurrence of a window), ``item_ids`` (ascending) and ``spans`` (covered
    stretches of the original text, in bytes of UTF-8, merged). One pass over each
    partition, no shuffle.

    A null or empty text has no words. Null and wordless items have no windows;
    an item with a null item_id marks words but is not listed. Repeated
    rows give repeated results, repeated items count once. Empty tables give
    empty results, or texts without hits. A text of any length is scanned whole. Other columns are ignored.
    """
    shared = blocks(items, block_bytes)
    schema = T.StructType([documents.schema[c] for c in keep] + RESULT.fields)

    run = uuid.uuid4().hex

    def searched(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            texts = list(map(Normal, batch["text"]))
            for k, block in enumerate(shared):
                windows = automaton(f"{run}-{k}", block, window)
                for text in texts:
                    text.scan(windows)
            yield {name: batch[name] for name in keep} | {
                "n_words": [len(t.words) for t in texts],
                "n_hit": [int(t.covered.sum()) for t in texts],
                "item_ids": [sorted(t.items) for t in texts],
                "spans": [t.spans() for t in texts],
            }

    return map_columns(documents.select(*dict.fromkeys([*keep, "text"])), schema, searched)


def contamination(documents: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``find_items`` by document: counts, a digest of the items found, and the verdict."""
    listed = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return find_items(documents, items, window=window).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
