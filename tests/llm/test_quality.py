from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tallyhouse.llm import quality
from tallyhouse.llm.queries import op5_quality_rules
from tests.llm.helpers import SMALL, by, documents, whole, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    runs = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often = Counter(runs)
    inside = {k + i for k, run in enumerate(runs) if often[run] > 1 for i in range(5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside), failed


def counts(row):
    return tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))


def test_query_equals_plain_counting(spark):
    found = by(op5_quality_rules(spark, SMALL).collect())
    rows = whole("documents")
    assert len(found) == len(rows)
    for row in rows:
        got = found[row["doc_id"]]
        assert counts(got) == base(row["text"])
        assert got["kept"] in ({False} if got["base_failed"] else {True, False})


def test_most_good_documents_stay_and_junk_goes(spark):
    found = by(op5_quality_rules(spark, SMALL).collect())
    good = [found[r["doc_id"]] for r in whole("labels") if r["quality"] == 1]
    bad = [found[r["doc_id"]] for r in whole("labels") if r["quality"] == 0]
    judged = [r for r in good if not r["base_failed"]]
    assert all(r["kept"] for r in judged)
    assert sum(r["kept"] for r in bad) <= 0.05 * len(bad)


def test_repeated_words_equal_plain_counting():
    draw = random.Random(4)
    for size in (0, 3, 5, 6, 40, 400, 5000):
        words = [draw.choice([b"a", b"b", b"c"]) if size < 50 else b"%d" % draw.randrange(9) for _ in range(size)]
        assert quality.repeated_words(words) == base(b" ".join(words).decode())[4]


def test_sketch_quartiles_are_close_and_merge(spark):
    draw = random.Random(9)
    values = [draw.lognormvariate(0, 1) for _ in range(4001)] + [0.0] * 400
    halves = [("en", "a" if k % 3 else "b", "word_length", v) for k, v in enumerate(values)]
    df = spark.createDataFrame(halves, "lang string, source string, ratio string, value double")
    sketch = df.groupBy("lang", "source", "ratio", quality.bucket(df["value"]).alias("bucket")).count().withColumnRenamed("count", "n")
    (merged,) = quality.quartiles(sketch, ["lang"]).collect()
    exact = sorted(values)
    for label, q in (("q1", 0.25), ("q3", 0.75)):
        assert merged[f"word_length_{label}"] == pytest.approx(exact[int(len(exact) * q)], rel=0.021)
    assert merged["texts"] == len(values)
    assert {r.source for r in quality.quartiles(sketch, ["lang", "source"]).collect()} == {"a", "b"}


def test_thresholds_follow_the_group(spark):
    """Symbols are normal in one source and not in the other; a small group uses its language's thresholds."""
    draw = random.Random(1)

    def text(share):
        return " ".join(f"w{draw.randrange(10**6)}{'#' if draw.random() < share else ''}" for _ in range(60))

    rows = [(k, text(0.5), "en", "code") for k in range(250)] + [(1000 + k, text(0), "en", "prose") for k in range(600)]
    rows += [(5000, text(0.5), "en", "code"), (5001, text(0.9), "en", "prose"), (5002, text(0), "en", "tiny"), (5003, text(1) + "#" * 500, "en", "tiny")]
    kept = {r.doc_id: r.kept for r in quality.judged(documents(spark, rows)).collect()}
    assert kept[5000] and not kept[5001] and kept[5002] and not kept[5003]
    assert sum(not v for k, v in kept.items() if k < 5000) == 0


def test_odd_rows(spark):
    good = " ".join(f"word{k}" for k in range(40))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, good), (4, good), (None, good, None, "s"), (6, good, "en", None), (7, "x " * 100_000)]
    df = with_clashes(documents(spark, rows), "n_words", "bucket", "ratio", "texts", "kept")
    found = quality.judged(df).collect()
    assert len(found) == len(rows)
    texts = {4: good, None: good, 6: good, 7: "x " * 100_000}
    for row in found:
        assert counts(row) == base(texts.get(row.doc_id))
        assert row.kept == (row.doc_id in (4, 6, None))
    assert quality.judged(df.limit(0)).collect() == []
