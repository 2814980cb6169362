from __future__ import annotations

import hashlib
import re

from tallyhouse.llm import decontam
from tallyhouse.llm.queries import op3_benchmark_decontamination
from tests.llm.helpers import SMALL, by, documents, whole, with_clashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute_force(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        item_words = words(item_text)
        size = min(window, len(item_words))
        for k in range(len(item_words) - size + 1) if size else ():
            for at in range(len(own) - size + 1):
                if own[at : at + size] == item_words[k : k + size]:
                    hit.update(range(at, at + size))
                    found.add(item)
    return len(own), len(hit), found


def test_query_equals_brute_force(spark):
    items = [(r["item_id"], r["text"]) for r in whole("benchmark")]
    found = by(op3_benchmark_decontamination(spark, SMALL).collect())
    rows = whole("documents")
    assert len(rows) == len(found) and any(r["contaminated"] for r in found.values())
    first = {" ".join(words(t)[k : k + 10]) for _, t in items for k in range(max(1, len(words(t)) - 9))}
    for row in rows:
        got = found[row["doc_id"]]
        own = words(row["text"])
        # The slow comparison where any ten words of an item can occur at all, and for a few others.
        if got["contaminated"] or row["doc_id"] % 40 == 0:
            n, hit, ids = brute_force(row["text"], items)
        else:
            n, hit, ids = len(own), 0, set()
            assert not any(" ".join(own[k : k + 10]) in first for k in range(max(1, len(own) - 9)))
        assert (got["n_words"], got["n_hit"], got["n_items"], got["contaminated"]) == (n, hit, len(ids), hit > 0)
        assert got["items_sha256"] == hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


def test_blocks_give_the_same_as_one_automaton(spark):
    docs, items = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    one = sorted(map(str, decontam.find_items(docs, items).where("n_hit > 0").collect()))
    many = sorted(map(str, decontam.find_items(docs, items, block_bytes=1500).where("n_hit > 0").collect()))
    assert one == many and one


def test_spans_lead_to_the_original_text(spark):
    text = "Start — alpha,  BETA\n(gamma) delta; end alpha beta gamma delta"
    items = spark.createDataFrame([(1, "Alpha beta gamma delta!"), (2, "zulu")], ITEMS)
    (row,) = decontam.find_items(documents(spark, [(1, text)]), items).collect()
    data = text.encode()
    assert [data[s.start : s.stop].decode() for s in row.spans] == ["alpha,  BETA\n(gamma) delta", "alpha beta gamma delta"]
    assert (row.n_words, row.n_hit, row.item_ids) == (11, 8, [1])


def test_odd_rows(spark):
    items = with_clashes(
        spark.createDataFrame([(1, None), (2, ""), (3, "..."), (4, "foo bar"), (4, "foo bar"), (None, "lone item"), (10, "foo bar")], ITEMS), "doc_id"
    )
    rows = [(1, None), (2, ""), (3, "foobar"), (4, "Foo  bar"), (4, "Foo  bar"), (5, "a lone item"), (None, "foo bar"), (6, "x " * 200_000 + "foo bar")]
    df = with_clashes(documents(spark, rows), "item_id", "n_hit", "word", "spans")
    found = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in decontam.contamination(df, items).collect()), key=repr)
    expected = [(1, 0, 0, 0), (2, 0, 0, 0), (3, 1, 0, 0), (4, 2, 2, 2), (4, 2, 2, 2), (5, 3, 2, 0), (None, 2, 2, 2), (6, 200_002, 2, 2)]
    assert found == sorted(expected, key=repr)
    assert decontam.contamination(df.limit(0), items).collect() == []
    assert {r.n_hit for r in decontam.contamination(df, items.limit(0)).collect()} == {0}
