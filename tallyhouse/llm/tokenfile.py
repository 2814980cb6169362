"""Token ids in files of fixed-width bit-packed blocks.

Every id takes the fewest bits that the vocabulary needs. Ids are packed in blocks
of ``BLOCK`` ids; a block begins on a whole byte and has an offset in the
file's table, so any range of ids is found by arithmetic and unpacked with numpy.

Layout, all numbers little-endian: 8 bytes ``TOKBITS1``; the blocks; the offsets of all
blocks and of their end (unsigned 64 bits each); for each document its doc_id (signed
64), whether it has one (8), and the place of its first id (unsigned 64); last the
number of ids, blocks and documents (unsigned 64 each) and the bits of an id
and ids of a block (unsigned 32 each).

Documents are range-partitioned by doc_id; each partition writes a file, streaming
its blocks. A file counts only once its row is in the stored list, so
files of failed or repeated tasks are never read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyhouse.llm import files
from tallyhouse.llm.common import Columns, Memo, map_columns, new_folder, stored

VOCABULARY = "word_bpe_49k.json"
VOCABULARY_SIZE = 49_408
END = 2
MAGIC = b"TOKBITS1"
BLOCK = 8192
TAIL = struct.Struct("<QQQII")
#: Ids that a task reads at a time.
READ_IDS = 1 << 20
#: Entries of each of the encoder's two caches.
CACHED = 600_000


def bits_for(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids, lowest bit first, one behind the other; zero bits fill the last byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=count).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little", count=count * bits)
    return spread.reshape(count, bits).astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class TokenWriter:
    """Writes one file; memory holds a block, and three numbers for each document."""

    def __init__(self, folder: str, name: str, bits: int, block: int = BLOCK):
        self.out, self.bits, self.block = files.writer(folder, name), bits, block
        self.out.write(MAGIC)
        self.offsets, self.waiting, self.held, self.ids = [len(MAGIC)], [], 0, 0
        self.documents: list[int | None] = []
        self.starts: list[int] = []

    def add(self, document: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"id {int(ids.max())} needs more than {self.bits} bits")
        self.documents.append(document)
        self.starts.append(self.ids)
        self.ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            self._write(self.held - self.held % self.block)

    def _write(self, count: int) -> None:
        every = np.concatenate(self.waiting) if self.waiting else np.empty(0, dtype=np.uint32)
        for start in range(0, count, self.block):
            data = pack(every[start : min(start + self.block, count)], self.bits)
            self.out.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.waiting, self.held = [every[count:]], len(every) - count

    def close(self) -> None:
        if self.held:
            self._write(self.held)
        present = np.array([d is not None for d in self.documents], dtype=np.uint8)
        self.out.write(np.array(self.offsets, dtype="<u8").tobytes())
        self.out.write(np.array([d or 0 for d in self.documents], dtype="<i8").tobytes())
        self.out.write(present.tobytes())
        self.out.write(np.array(self.starts, dtype="<u8").tobytes())
        self.out.write(TAIL.pack(self.ids, len(self.offsets) - 1, len(self.documents), self.bits, self.block))
        self.out.close()


class TokenReader:
    """Random access to the ids of one file."""

    def __init__(self, folder: str, name: str):
        self.data = files.reader(folder, name)
        size = self.data.size()
        self.ids, blocks, documents, self.bits, self.block = TAIL.unpack(self.data.read_at(TAIL.size, size - TAIL.size))
        table = 8 * (blocks + 1) + 17 * documents
        index = self.data.read_at(table, size - TAIL.size - table)
        if self.data.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{name} is no token file")
        self.offsets = np.frombuffer(index, dtype="<u8", count=blocks + 1)
        at = 8 * (blocks + 1)
        numbers = np.frombuffer(index, dtype="<i8", count=documents, offset=at).tolist()
        present = np.frombuffer(index, dtype=np.uint8, count=documents, offset=at + 8 * documents).tolist()
        self.documents = [number if there else None for number, there in zip(numbers, present)]
        self.starts = np.frombuffer(index, dtype="<u8", count=documents, offset=at + 9 * documents).astype(np.int64)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop`` of the file, by one range read of their blocks."""
        stop = min(stop, self.ids)
        if start >= stop:
            return np.empty(0, dtype=np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        begin, end = int(self.offsets[first]), int(self.offsets[last + 1])
        data = self.data.read_at(end - begin, begin)
        parts = []
        for k in range(first, last + 1):
            count = min(self.block, self.ids - k * self.block)
            parts.append(unpack(data[int(self.offsets[k]) - begin : int(self.offsets[k + 1]) - begin], count, self.bits))
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]

    def each(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Document, first place and ids of all documents in order, a bounded stretch at a time."""
        ends = np.append(self.starts[1:], self.ids) if len(self.starts) else self.starts
        k = 0
        while k < len(self.documents):
            last = max(k + 1, int(np.searchsorted(ends, self.starts[k] + READ_IDS, side="right")))
            ids = self.read(int(self.starts[k]), int(ends[last - 1]))
            for d in range(k, last):
                base = int(self.starts[k])
                yield self.documents[d], int(self.starts[d]), ids[int(self.starts[d]) - base : int(ends[d]) - base]
            k = last


#: Byte-level vocabularies write the bytes that have no visible character as letters from U+0100 on, in order.
VISIBLE = {
    byte: 256 + k
    for k, byte in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255))
}


class WordCodec:
    """Ids by the tokenizers library, with caches of what recurs.

    White space only parts tokens here, and no token or normal form reaches
    across it, so the stretches between spaces are encoded by themselves. A stretch of
    Latin letters with one mark behind is encoded as the letters and the mark. A word of
    Latin letters goes to the library's model as it would arrive there, in lower
    case and by visible characters for bytes; everything else takes the library's whole way.
    """

    MARKS = frozenset(",.;:!?")
    #: Below are letters whose lower case is one letter and whose normal form is themselves.
    LATIN = "\u0130"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = Memo(self._word, CACHED)
        self.marks = {mark: self._whole(mark) for mark in self.MARKS}
        self.stretches = Memo(self._stretch, CACHED)

    def _word(self, word: str) -> bytes:
        """Ids of a lower-case word of Latin letters."""
        seen = word if word.isascii() else word.encode().decode("latin-1").translate(VISIBLE)
        return array("I", [token.id for token in self.model.tokenize(seen)]).tobytes()

    def _whole(self, stretch: str) -> bytes:
        return array("I", self.tokenizer.encode(stretch, add_special_tokens=False).ids).tobytes()

    def _is_plain(self, word: str) -> bool:
        return word.isalpha() and (word.isascii() or max(word) < self.LATIN)

    def _stretch(self, stretch: str) -> bytes:
        mark = stretch[-1:] if stretch[-1:] in self.MARKS else ""
        word = stretch[:-1] if mark else stretch
        if not self._is_plain(word):
            return self._whole(stretch)
        ids = self.words[word.lower()]
        return ids + self.marks[mark] if mark else ids

    def encode(self, text: str | None) -> np.ndarray:
        stretches = (text or "").replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(self.stretches.__getitem__, stretches)), dtype="<u4")


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> WordCodec:
    return WordCodec(public_tokenizers.path(vocabulary))


FILES = T.StructType(
    [
        T.StructField("part", T.IntegerType(), False),
        T.StructField("file", T.StringType(), False),
        T.StructField("n_documents", T.LongType(), False),
        T.StructField("n_tokens", T.LongType(), False),
    ]
)
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType(), False),
        T.StructField("n_tokens", T.LongType(), False),
        T.StructField("ids_crc32", T.LongType(), False),
    ]
)


def write_token_files(
    documents: DataFrame, folder: str, vocabulary: str = VOCABULARY, vocabulary_size: int = VOCABULARY_SIZE, end: int = END
) -> DataFrame:
    """Encode each ``text``, append ``end``, and write files in ascending doc_id order.

    Returns the stored list of files, ``part, file, n_documents, n_tokens, start``; ``start``
    is the number of ids in all files before. Rows that repeat a doc_id follow one another in the
    order of their text's hash; a null doc_id comes first. A null or empty text
    has the end id alone. A text of any length is encoded whole; a file's blocks are written as they fill. Other columns are
    ignored. An empty table gives no file.
    """
    bits = bits_for(vocabulary_size)
    order = ["doc_id", F.xxhash64("text")]
    dealt = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(*order).sortWithinPartitions(*order)

    def written(batches: Iterator[Columns]) -> Iterator[Columns]:
        out, own, part = None, codec(vocabulary), TaskContext.get().partitionId()
        name = f"tokens-{part:06d}-{uuid.uuid4().hex}.bin"
        last = np.array([end], dtype=np.uint32)
        for batch in batches:
            for doc, ids in zip(batch["doc_id"], map(own.encode, batch["text"])):
                out = out or TokenWriter(folder, name, bits)
                out.add(doc, np.concatenate([ids, last]))
        if out:
            out.close()
            yield {"part": [part], "file": [name], "n_documents": [len(out.documents)], "n_tokens": [out.ids]}

    listed = stored(map_columns(dealt, FILES, written), "token-files")
    # One row for each file: a small, single-task sum.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(listed: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the listed files."""

    def read(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for name, start in zip(batch["file"], batch["start"]):
                out: Columns = {c: [] for c in DOCUMENTS.names}
                for doc, at, ids in TokenReader(folder, name).each():
                    out["doc_id"].append(doc)
                    out["start"].append(start + at)
                    out["n_tokens"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                yield out

    tasks = listed.repartition(max(1, listed.count()), "file")
    return map_columns(tasks.select("file", "start"), DOCUMENTS, read)


def token_files(documents: DataFrame) -> DataFrame:
    """Write the documents' ids and read them back: one row for each document."""
    folder = new_folder(documents.sparkSession, "token-data")
    return read_token_files(write_token_files(documents, folder), folder)
