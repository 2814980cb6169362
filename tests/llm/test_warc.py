from __future__ import annotations

import gzip
import hashlib

from tallyhouse.llm import files, warc
from tallyhouse.llm.common import new_folder
from tallyhouse.llm.queries import op4_warc_archives
from tests.llm.helpers import SMALL, by, whole, with_clashes

PAGES = "page_id bigint, url string, html string"


def expected(rows):
    """Rows of ``(page_id, url, html)``: what the archives must tell."""
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if page is not None and len(data) >= 100:
            first[data] = min(first.get(data, page), page)
    found = []
    for page, _, html in rows:
        data = (html or "").encode()
        original = first.get(data)
        again = page is not None and original is not None and page != original
        found.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", original if again else None))
    return sorted(found, key=repr)


def got(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_query_equals_the_payloads(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in whole("pages")]
    df = op4_warc_archives(spark, SMALL)
    assert df.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert got(df) == expected(rows)


def test_odd_rows(spark):
    long = "é" * 300_000
    rows = [(5, "http://a.b/x", "q" * 100), (2, "http://a.b/x", "q" * 100), (9, None, "q" * 100), (9, None, "q" * 100), (None, "http://a.b/x", "q" * 100)]
    rows += [(1, "", None), (3, "odd url\n\twith space", ""), (4, "http://a.b/x", "q" * 99), (6, "http://A.b/x?é#", "q" * 99), (7, "x://y", long), (8, "x://y", long)]
    df = with_clashes(spark.createDataFrame(rows, PAGES), "digest", "refers_to", "file", "offset")
    assert got(warc.archived(df)) == expected(rows)
    assert warc.archived(df.limit(0)).collect() == []


def test_archives_rotate_and_are_plain_warc(spark):
    rows = [(k, f"http://h{k % 7}.example.org/{k}", f"page {k} " * 40) for k in range(60)]
    folder = new_folder(spark, "test-archives")
    pages = warc.with_originals(spark.createDataFrame(rows, PAGES).coalesce(1))
    captures = warc.write_archives(pages, folder, archive_bytes=2000).collect()
    names = {c.file for c in captures}
    assert len(names) > 3 and len(captures) == 60
    seen = 0
    for name in names:
        with files.reader(folder, name) as data:
            records = gzip.decompress(data.read()).split(b"WARC/1.1\r\n")[1:]
        assert all(r.endswith(b"\r\n\r\n") for r in records)
        seen += len(records)
    assert seen == 60


def test_index_finds_by_binary_search(spark):
    rows = [(f"com,example,{k:04d})/ {k}", f"f{k % 3}", k * 10, 7) for k in range(0, 2000, 2)]
    folder = new_folder(spark, "test-index")
    listed = warc.write_index(spark.createDataFrame(rows, warc.CAPTURES), folder, block_lines=16)
    wanted = spark.createDataFrame([(f"com,example,{k:04d})/ {k}",) for k in range(2000)] + [("a",), ("z",)], "key string")
    assert got(warc.look_up(wanted, listed, folder)) == sorted(rows, key=repr)


def test_keys():
    assert warc.url_key("https://WWW.Example.com:80/a?b#c") == "com:80,example,www)/a?b#c"
    assert warc.url_key("http://x.org") == "org,x)/"
    assert warc.url_key(None) == ")/" and warc.url_key("a b") == ")a%20b"
    assert warc.capture_key("x://y", 3, "d") < warc.capture_key("x://y", 20, "d")


def test_records_round_trip():
    payload = "a\r\n\r\nb é".encode()
    warc_fields, http, body = warc.parsed(warc.unpacked(warc.packed(warc.record("http://x/", 4, payload, "d" * 64, None))))
    assert body == payload and warc_fields["WARC-Type"] == "response" and http["Content-Length"] == str(len(payload))
    again, http, body = warc.parsed(warc.record("http://x/", 9, payload, "d" * 64, 4))
    assert body == b"" and again["WARC-Refers-To"] == warc_fields["WARC-Record-ID"] and http["Content-Length"] == str(len(payload))


def test_each_page_is_read_once(spark):
    assert len(by(op4_warc_archives(spark, SMALL).collect(), "page_id")) == len(whole("pages"))
