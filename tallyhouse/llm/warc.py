"""WARC archives with a two-level capture index.

Writing: each page becomes a record, compressed by itself, in an archive of
bounded size. Of pages with equal payloads the first carries the payload, the
others are revisit records that point to it.

Index: captures are sorted by their URL key, the host reversed, into compressed
blocks of lines. Each index file has a sparse directory at its end, the first key and the
place of every block; the driver holds only the first key of every file.

Lookup: a key finds its file by the files' first keys, its block by binary
search in that file's directory, its line by binary search in that block, and then its
record by a range read of the archive.

Files count only once their rows are in a stored table, so what failed or repeated tasks
left behind is never read.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm import files
from tallyhouse.llm.common import Columns, map_columns, new_folder, stored, text_bytes

#: Payloads below this size are never stored as revisits.
LEAST_REVISIT = 100
#: Compressed bytes after which a task goes on in a new archive.
ARCHIVE_BYTES = 1 << 30
#: Lines of a block of the index.
BLOCK_LINES = 1000
#: Bytes between two records that a reader rather reads than skips by another request.
GAP = 1 << 16
READ_BYTES = 4 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TAIL = struct.Struct("<QQ")

CAPTURES = T.StructType(
    [
        T.StructField("key", T.StringType(), False),
        T.StructField("file", T.StringType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("length", T.LongType(), False),
    ]
)
INDEX_FILES = T.StructType(
    [T.StructField("file", T.StringType(), False), T.StructField("first", T.StringType(), False), T.StructField("lines", T.LongType(), False)]
)
RECORDS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("payload_bytes", T.LongType(), False),
        T.StructField("payload_digest", T.StringType(), False),
        T.StructField("record_type", T.StringType(), False),
        T.StructField("refers_to", T.LongType()),
    ]
)

UNSAFE = re.compile(r"[\x00-\x20\x7f%]")


def escaped(url: str) -> str:
    """A URL without white space and control characters, on one line."""
    return UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}" if m[0] != "%" else "%", url)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then the rest. ``)/`` for null."""
    scheme, mark, rest = escaped(url or "").partition("://")
    if not mark:
        return f"){scheme or '/'}"
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    return ",".join(rest[:end].lower().split(".")[::-1]) + ")" + (rest[end:] or "/")


def capture_key(url: str | None, page: int | None, digest: str) -> str:
    """A key of its own for each capture: URL key, page and payload."""
    number = "-" if page is None else f"{page + (1 << 63):020d}"
    return f"{url_key(url)} {number} {digest}"


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page} {digest}')}>"


def record(url: str | None, page: int | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC record: a response, or a revisit without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", escaped(url or "") or f"urn:page:{page}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Length", str(len(block))),
    ]
    if page is not None:
        fields.append(("X-Page-Id", str(page)))
    if refers_to is not None:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            ("X-Refers-To-Page-Id", str(refers_to)),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(warc["Content-Length"])]
    http_head, _, payload = block.partition(b"\r\n\r\n")
    return warc, dict(line.split(": ", 1) for line in http_head.decode().split("\r\n")[1:]), payload


def packed(data: bytes) -> bytes:
    """One gzip member."""
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def unpacked(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


def with_originals(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id, url, html, digest, refers_to``: the first page with the same payload, null for that page itself."""
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    long_ = pages.where(F.octet_length("html") >= least).select("page_id", "digest")
    groups = stored(
        long_.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"), "payload-groups"
    )
    # Digests alone are joined, so a payload with very many copies moves few bytes, and Spark may split it.
    revisits = stored(long_.join(groups, "digest").where("page_id > refers_to").distinct(), "revisits")
    return pages.join(revisits.hint("shuffle_hash"), ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each row of ``with_originals``; returns the stored captures."""

    def written(batches: Iterator[Columns]) -> Iterator[Columns]:
        out, name, at = None, "", 0
        for batch in batches:
            found: Columns = {c: [] for c in CAPTURES.names}
            for page, url, html, digest, refers_to in zip(*(batch[c] for c in ("page_id", "url", "html", "digest", "refers_to"))):
                if out is None:
                    name, at = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = files.writer(folder, name)
                data = packed(record(url, page, text_bytes(html), digest, refers_to))
                out.write(data)
                for column, value in zip(CAPTURES.names, (capture_key(url, page, digest), name, at, len(data))):
                    found[column].append(value)
                at += len(data)
                if at >= archive_bytes:
                    out.close()
                    out = None
            yield found
        if out is not None:
            out.close()

    return stored(map_columns(pages, CAPTURES, written), "captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort the captures into index files; returns the stored list of files with their first keys."""
    dealt = captures.repartitionByRange("key").sortWithinPartitions("key")

    def written(batches: Iterator[Columns]) -> Iterator[Columns]:
        out = None
        for batch in batches:
            for row in zip(*(batch[c] for c in CAPTURES.names)):
                out = out or IndexWriter(folder, f"index-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.cdx.gz", block_lines)
                out.add(row)
        if out:
            out.close()
            yield {"file": [out.name], "first": [out.directory[0][0]], "lines": [out.total]}

    return stored(map_columns(dealt, INDEX_FILES, written), "index-files")


class IndexWriter:
    """Writes one file of the index: compressed blocks of sorted lines, then their directory."""

    def __init__(self, folder: str, name: str, block_lines: int):
        self.out, self.name, self.block_lines = files.writer(folder, name), name, block_lines
        self.lines: list[str] = []
        self.directory: list[tuple[str, int, int]] = []
        self.at = self.total = 0

    def add(self, row: tuple) -> None:
        self.lines.append("\t".join(map(str, row)))
        self.total += 1
        if len(self.lines) == self.block_lines:
            self._block()

    def _block(self) -> None:
        data = packed("\n".join(self.lines).encode())
        self.out.write(data)
        self.directory.append((self.lines[0].split("\t", 1)[0], self.at, len(data)))
        self.at, self.lines = self.at + len(data), []

    def close(self) -> None:
        if self.lines:
            self._block()
        table = packed(json.dumps(self.directory).encode())
        self.out.write(table)
        self.out.write(TAIL.pack(self.at, len(table)))
        self.out.close()


class IndexFile:
    """One file of the index: its directory, and the block that was read last."""

    def __init__(self, folder: str, name: str):
        self.data = files.reader(folder, name)
        size = self.data.size()
        at, length = TAIL.unpack(self.data.read_at(TAIL.size, size - TAIL.size))
        self.directory = json.loads(unpacked(self.data.read_at(length, at)))
        self.firsts = [first for first, _, _ in self.directory]
        self.block, self.keys, self.lines = -1, [], []

    def find(self, key: str) -> list[str] | None:
        """Key, file, offset and length of a capture."""
        block = bisect_right(self.firsts, key) - 1
        if block < 0:
            return None
        if block != self.block:
            _, at, length = self.directory[block]
            self.lines = unpacked(self.data.read_at(length, at)).decode().split("\n")
            self.keys = [line.split("\t", 1)[0] for line in self.lines]
            self.block = block
        at = bisect_left(self.keys, key)
        return self.lines[at].split("\t") if at < len(self.keys) and self.keys[at] == key else None


def look_up(wanted: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """Captures of the ``wanted (key)`` found through the index; keys without a capture are left out."""
    known = sorted((row.first, row.file) for row in index.select("first", "file").collect())
    firsts, names = [first for first, _ in known], [name for _, name in known]
    placed_type = T.StructType([T.StructField("part", T.IntegerType(), False), T.StructField("key", T.StringType(), False)])

    def placed(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            parts = [bisect_right(firsts, key) - 1 for key in batch["key"]]
            found = [k for k, part in enumerate(parts) if part >= 0]
            yield {"part": [parts[k] for k in found], "key": [batch["key"][k] for k in found]}

    def searched(batches: Iterator[Columns]) -> Iterator[Columns]:
        part, own = None, None
        for batch in batches:
            rows = []
            for row_part, key in zip(batch["part"], batch["key"]):
                if row_part != part:
                    part, own = row_part, IndexFile(folder, names[row_part])
                line = own.find(key)
                if line:
                    rows.append((line[0], line[1], int(line[2]), int(line[3])))
            yield {name: [row[k] for row in rows] for k, name in enumerate(CAPTURES.names)}

    parts = map_columns(wanted.select("key"), placed_type, placed)
    dealt = parts.repartition(max(1, len(known)), "part").sortWithinPartitions("part", "key")
    return map_columns(dealt, CAPTURES, searched)


def read_records(captures: DataFrame, folder: str, spread: int) -> DataFrame:
    """Page, payload size and digest, type and original of each capture's record.

    Captures are dealt by archive and stretch of it; neighbours in a stretch share a range read.
    """
    stretch = F.floor(F.col("offset") / (16 * READ_BYTES))

    def read(batches: Iterator[Columns]) -> Iterator[Columns]:
        name, data = None, None
        for batch in batches:
            out: Columns = {c: [] for c in RECORDS.names}
            rows = list(zip(batch["file"], batch["offset"], batch["length"]))
            k = 0
            while k < len(rows):
                file, begin, length = rows[k]
                last, end = k, begin + length
                while last + 1 < len(rows) and rows[last + 1][0] == file and rows[last + 1][1] <= end + GAP and end - begin < READ_BYTES:
                    last += 1
                    end = max(end, rows[last][1] + rows[last][2])
                if file != name:
                    name, data = file, files.reader(folder, file)
                piece = data.read_at(end - begin, begin)
                for _, offset, size in rows[k : last + 1]:
                    for column, value in zip(RECORDS.names, facts(unpacked(piece[offset - begin : offset - begin + size]))):
                        out[column].append(value)
                k = last + 1
            yield out

    dealt = captures.repartition(spread, "file", stretch).sortWithinPartitions("file", "offset")
    return map_columns(dealt, RECORDS, read)


def facts(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """What a record tells about its page; a response's payload is measured, and must fit its digest."""
    warc, http, payload = parsed(data)
    digest = warc["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(http["Content-Length"])
    if warc["WARC-Type"] == "response":
        size, own = len(payload), hashlib.sha256(payload).hexdigest()
        if own != digest:
            raise ValueError(f"payload of {warc['WARC-Record-ID']} does not fit its digest")
    page, refers_to = warc.get("X-Page-Id"), warc.get("X-Refers-To-Page-Id")
    return int(page) if page else None, size, digest, warc["WARC-Type"], int(refers_to) if refers_to else None


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages (page_id, url, html)``, look every page up in the index, and read its record back.

    Of equal payloads of at least 100 bytes, the page with the smallest page_id is the
    response, the others revisit it. Rows that repeat page_id and payload are
    all of one type. A page without a page_id is a response always. A null html is
    the empty payload; a null or odd URL has a key of its own kind and is escaped. An empty
    table gives no files and no rows. Other columns are ignored.
    """
    spark = pages.sparkSession
    archive, index = new_folder(spark, "archives"), new_folder(spark, "capture-index")
    captures = write_archives(with_originals(pages), archive)
    listed = write_index(captures, index)
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    wanted = wanted_keys(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", digest.alias("digest")))
    tasks = max(1, listed.count())
    return read_records(look_up(wanted, listed, index), archive, tasks)


def wanted_keys(pages: DataFrame) -> DataFrame:
    """The capture key of each row."""

    def keyed(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            yield {"key": list(map(capture_key, batch["url"], batch["page_id"], batch["digest"]))}

    return map_columns(pages, T.StructType([T.StructField("key", T.StringType(), False)]), keyed)
