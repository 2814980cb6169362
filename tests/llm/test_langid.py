from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import langid
from tallyhouse.llm.queries import op9_language_id
from tests.llm.helpers import SMALL, by, documents, whole, with_clashes


def test_query_is_right_on_held_out_texts(spark):
    found = by(op9_language_id(spark, SMALL).collect())
    rows = whole("documents")
    assert len(found) == len(rows)
    right = total = 0
    for row in rows:
        got = found[row["doc_id"]]
        assert got["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= got["score"] <= 1
        if got["held_out"] and row["lang"] is not None and langid.has_letter(row["text"]):
            total += 1
            right += got["lang_pred"] == row["lang"]
    assert total > 20 and right >= 0.95 * total


def test_frequencies_count_each_text_once(spark):
    texts = ["aba", "ab", "", None, "123", "ab ab"]
    rows = documents(spark, list(enumerate(texts)))
    seen, total = langid.document_frequencies(rows.repartition(3))
    expected = Counter(int(b) for t in texts if langid.has_letter(t) for b in langid.gram_counts(t)[0])
    assert total == 3
    assert {int(k): int(seen[k]) for k in np.flatnonzero(seen)} == dict(expected)


def test_grams_do_not_depend_on_pieces(monkeypatch):
    text = "Straße — élève, l'été 12 x" * 40
    one = langid.gram_counts(text)
    points = len(f" {langid.GAPS.sub(' ', text.lower()).strip()} ")
    assert one[1].sum() == points + (points - 1) + (points - 2)
    monkeypatch.setattr(langid, "PIECE", 50)
    many = langid.gram_counts(text)
    assert (one[0] == many[0]).all() and (one[1] == many[1]).all()


def test_temperature_mends_too_certain_scores():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3))
    labels = [int(rng.choice(3, p=langid.softmax(row))) for row in logits]
    assert langid.temperature([row * 4 for row in logits], labels) == pytest.approx(4, rel=0.15)
    assert langid.temperature([], []) == 1.0


def test_penalties_leave_weights_sparse():
    rng = np.random.default_rng(2)
    leader = langid.Leader(2)
    for _ in range(300):
        label = int(rng.integers(2))
        noise = rng.choice(np.arange(10, 500), 5, replace=False)
        leader.learn(np.r_[label, noise], np.r_[1.0, np.full(5, 0.002)], label)
    weights = leader.weights(slice(None))
    assert weights[0, 0] > 0.5 > -0.5 > weights[0, 1]
    assert (weights[:, 10:500] == 0).mean() > 0.5


def test_sample_is_bounded_and_without_repeats(spark):
    rows = [(k, f"text {k}", "en") for k in range(50)] + [(100 + k, "copy", "de") for k in range(50)]
    sample = langid.training_sample(documents(spark, rows).select("lang", "text"), 10).collect()
    assert Counter(r.lang for r in sample) == {"en": 10, "de": 1}


def test_only_counts_of_sampled_texts_travel(spark):
    long = "the cat and " * 200_000
    sample = langid.training_sample(documents(spark, [(1, long, "en"), (2, "123", "en")]).select("lang", "text"), 10)
    (row,) = langid.sample_counts(sample).collect()
    found, counts = langid.gram_counts(long)
    assert np.frombuffer(row.found, dtype="<u2").tolist() == found.tolist()
    assert np.frombuffer(row.counts, dtype="<i8").tolist() == counts.tolist()
    assert len(row.found) + len(row.counts) < len(long) / 100


def test_odd_rows(spark):
    rows = [(k, f"the cat and the dog number {k}", "en") for k in range(30)] + [(100 + k, f"der hund und die katze {k}", "de") for k in range(30)]
    rows += [(200, None, "en"), (201, "", "en"), (202, "123 !", None), (203, "der hund und die katze", None), (None, "the dog", None), (203, "der hund und die katze", None)]
    rows += [(204, "the cat and " * 100_000, "xx")]
    df = with_clashes(documents(spark, rows), "mark", "rank", "bucket", "score", "lang_pred")
    classifier = langid.trained(df, F.coalesce(F.col("doc_id") < 200, F.lit(False)))
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.predicted(df, classifier).collect()}
    assert found[200] == found[201] == found[202] == ("und", 0.0)
    assert found[203][0] == "de" and found[None][0] == "en" and found[204][0] == "en"
    assert all(math.isfinite(s) for _, s in found.values())
    nothing = langid.trained(df, F.lit(False))
    assert {(r.lang_pred, r.score) for r in langid.predicted(df, nothing).collect()} == {("und", 0.0)}
    assert langid.predicted(df.limit(0), classifier).collect() == []
