from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import pylm
from tallyhouse.llm.queries import op8_pitman_yor_scores
from tests.llm.helpers import SMALL, by, documents, whole, with_clashes


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def test_query_counts_and_base_scores(spark):
    rows = whole("documents")
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1 for r in rows}
    counts = Counter(t for r in rows if not held[r["doc_id"]] for t in tokens(r["text"]))
    total, different = sum(counts.values()), len(counts)
    found = by(op8_pitman_yor_scores(spark, SMALL).collect())
    assert len(found) == len(rows)
    better = 0
    for row in rows:
        got, own = found[row["doc_id"]], tokens(row["text"])
        assert (got["held_out"], got["n_tokens"], got["train_tokens"]) == (held[row["doc_id"]], len(own), total)
        assert got["n_known"] == sum(t in counts for t in own)
        assert got["base_score"] == pytest.approx(sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (different + 1))) for t in own))
        assert got["score"] < 0
        better += held[row["doc_id"]] and got["score"] > got["base_score"]
    assert better > 0.9 * sum(held.values())


def test_probabilities_of_a_context_add_up_to_one(spark):
    """Over all known words and the unknown one, after every context, seen or not."""
    texts = ["the cat sat on the mat", "the dog sat on a log", "a cat and a dog", "on and on the cat sat"] * 5
    df = documents(spark, list(enumerate(texts)))
    counts = pylm.counted(df, 1)
    (start,), n = pylm.summed(counts)
    assert n == sum(len(tokens(t)) for t in texts)
    blocks = pylm.sampled(counts, start, 3, 2, seed=4)
    totals, _ = pylm.summed(blocks, 2, start.discounts)
    (row,) = blocks.collect()
    model = pylm.Model(row.dishes, row.tables, totals, n)
    words = np.append(model.words, np.uint64(12345))
    order = np.argsort(words)
    for context in (0, int.from_bytes(b"he", "big"), int.from_bytes(b"a", "big"), int.from_bytes(b"zz", "big")):
        asked = pylm.Dishes(words[order], np.arange(len(words)), np.full(len(words), context, dtype=np.uint16), np.ones(len(words), dtype=np.uint32))
        assert (10 ** model.score(asked)[0]).sum() == pytest.approx(1.0)


def test_totals_follow_the_tables(spark):
    df = documents(spark, [(k, f"w{k % 7} w{k % 3} x w{k % 5}") for k in range(200)])
    counts = pylm.counted(df, 3)
    (start,), _ = pylm.summed(counts)
    (after,), _ = pylm.summed(pylm.sampled(counts, start, 2, 1, seed=2), discounts=start.discounts)
    for level in (0, 1):
        assert after.tables[level].sum() == after.customers[level + 1].sum()
    assert after.customers[0].sum() == start.customers[0].sum() == sum(len(tokens(f"w{k % 7} w{k % 3} x w{k % 5}")) for k in range(200))


def test_seating_has_the_expected_number_of_tables():
    """For one dish alone, tables follow the process with the base folded in; exact expectation by a forward pass."""
    d, s, others, base, n = 0.5, 1.0, 20.0, 0.3, 12
    # Weight of each count of tables: all ways to seat, with the choices' weights.
    weights = {1: 1.0}
    for seated in range(1, n):
        following: dict[int, float] = {}
        for t, w in weights.items():
            following[t] = following.get(t, 0) + w * (seated - d * t)
            following[t + 1] = following.get(t + 1, 0) + w * (s + d * (others + t)) * base
        weights = following
    expected = sum(t * w for t, w in weights.items()) / sum(weights.values())
    many = 20_000
    drawn = pylm.seated(np.full(many, n), d, s, np.full(many, others), np.full(many, base), np.random.default_rng(3))
    assert drawn.min() >= 1 and drawn.max() <= n
    assert drawn.mean() == pytest.approx(expected, rel=0.08)


def test_log_gamma():
    x = np.array([0.05, 0.5, 1.0, 2.5, 30.0, 1e6])
    assert pylm.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-8, abs=1e-8)


def test_dishes_pack_and_merge():
    words = np.array([5, 3, 5, 9, 5], dtype=np.uint64)
    dishes = pylm.Dishes.merged(words, np.array([1, 2, 1, 7, 4]), np.array([1, 1, 2, 1, 1]))
    again = pylm.Dishes.unpacked(dishes.packed())
    assert list(zip(again.words[again.word].tolist(), again.context.tolist(), again.count.tolist())) == [(3, 2, 1), (5, 1, 3), (5, 4, 1), (9, 7, 1)]


def test_blocks_and_stretches_do_not_change_counts(spark, monkeypatch):
    df = documents(spark, [(k, f"a b{k % 4} c{k % 9} a") for k in range(90)])
    one = pylm.language_model_scores(df, F.lit(True), blocks=1)
    monkeypatch.setattr(pylm, "STRETCH_TOKENS", 50)
    many = pylm.language_model_scores(df, F.lit(True), blocks=5)
    a, b = by(one.collect()), by(many.collect())
    for doc in a:
        assert (a[doc]["n_tokens"], a[doc]["n_known"]) == (b[doc]["n_tokens"], b[doc]["n_known"])
        assert a[doc]["base_score"] == pytest.approx(b[doc]["base_score"])
        assert a[doc]["score"] == pytest.approx(b[doc]["score"], rel=0.1)


def test_large_blocks_are_dealt_to_several_tasks(spark, monkeypatch):
    df = documents(spark, [(k, f"a b{k % 4}") for k in range(40)])
    plain = {r.doc_id: r.score for r in pylm.language_model_scores(df, F.lit(True), blocks=2).collect()}
    monkeypatch.setattr(pylm, "TASK_TOKENS", 20)
    monkeypatch.setattr(pylm, "STRETCH_TOKENS", 10)
    assert {r.doc_id: r.score for r in pylm.language_model_scores(df, F.lit(True), blocks=2).collect()} == pytest.approx(plain, rel=0.1)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (5, "a " * 300_000), (6, "é\t\n漢")]
    df = with_clashes(documents(spark, rows), "stretch", "block", "salt", "model", "sums")
    found = pylm.language_model_scores(df, F.col("doc_id").isNotNull()).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in found), key=repr) == sorted([(1, 1), (2, 1), (2, 1), (None, 3), (5, 300_001), (6, 3)], key=repr)
    assert all(math.isfinite(r.score) for r in found)
    assert pylm.language_model_scores(df.limit(0), F.lit(True)).collect() == []
    untrained = pylm.language_model_scores(df, F.lit(False)).collect()
    assert len(untrained) == len(rows) and all(r.n_known == 0 and r.score == 0 for r in untrained)


def test_the_whole_previous_token_is_the_context(spark):
    """Two previous tokens that share their last two bytes; also in blocks that never saw the followers of a context."""
    df = documents(spark, [(k, "bathe apple") for k in range(200)] + [(k, "lathe berry") for k in range(200, 400)] + [(500, "bathe apple"), (501, "bathe berry")])
    for blocks in (1, 5):
        found = by(pylm.language_model_scores(df, F.col("doc_id") < 500, blocks=blocks).collect())
        assert found[500]["score"] - found[501]["score"] > 1.2


@pytest.mark.parametrize(("n", "d", "others", "base"), [(2, 0.7, 5, 0.2), (800, 0.5, 20, 0.3), (800, 0.9, 1e4, 0.01), (1024, 0.8, 1e5, 0.02)])
def test_tables_of_many_customers_follow_the_exact_distribution(n, d, others, base):
    """By a forward pass over the customers; three seatings one by one gave 27.5 tables in place of 10.8 in the second case."""
    weights = np.zeros(n + 1)
    weights[1] = 1.0
    for seated in range(1, n):
        t = np.arange(n + 1)
        following = weights * np.maximum(seated - d * t, 0)
        following[1:] += (weights * (1.0 + d * (others + t)) * base)[:-1]
        weights = following / following.max()
    weights /= weights.sum()
    mean = (weights * np.arange(n + 1)).sum()
    deviation = math.sqrt((weights * (np.arange(n + 1) - mean) ** 2).sum())
    many = 4000
    drawn = pylm.seated(np.full(many, n), d, 1.0, np.full(many, others), np.full(many, base), np.random.default_rng(7))
    assert abs(drawn.mean() - mean) < 5 * deviation / math.sqrt(many)
    assert drawn.std() == pytest.approx(deviation, rel=0.08)


def test_dishes_are_stored_once_and_shuffles_removed(spark, monkeypatch, tmp_path):
    """Generations of seatings name the file of the dishes; the setting that removes shuffle files is put back."""
    monkeypatch.setattr("tallyhouse.llm.common.checkpoint_dir", lambda _: f"file://{tmp_path}")
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(setting, None), []
    plain = pylm.stored
    monkeypatch.setattr(pylm, "stored", lambda df, name: (seen.append(spark.conf.get(setting)), plain(df, name))[1])
    found = pylm.language_model_scores(spark.read.parquet(f"{SMALL}/documents.parquet"), F.col("doc_id") % 5 != 1, blocks=3)
    assert found.count() == len(whole("documents"))
    assert seen == ["true"] * 3 and spark.conf.get(setting, None) == before
    size = Counter()
    for path in tmp_path.rglob("*"):
        if path.is_file():
            size[path.relative_to(tmp_path).parts[0].rsplit("-", 1)[0]] += path.stat().st_size
    assert size["language-model-blocks"] + size["language-model-counts"] < size["language-model-files"]


def test_a_block_scores_its_own_dishes_as_any_others(spark):
    df = documents(spark, [(k, f"a b{k % 4} c{k % 9} a") for k in range(90)] + [(90, "c1 b2 new b3")])
    counts = pylm.counted(df, 1, F.col("doc_id") < 90)
    (start,), n = pylm.summed(counts)
    blocks = pylm.sampled(counts, start, 2, 2, seed=4)
    totals, _ = pylm.summed(blocks, 2, start.discounts)
    (row,) = blocks.collect()
    model = pylm.Model(row.dishes, row.tables, totals, n)
    every = pylm.Dishes.unpacked(pylm.read(row.dishes))
    for own, asked in zip(model.own(), model.score(every)):
        assert own == pytest.approx(asked)
    assert (every.count == 0).any()


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_of_stretches_are_those_of_plain_splitting(kind):
    texts = ["a b", "  C\tD\x0b\x0ce \r\n", None, "", " ", "é\x1cz \xa0x 漢 Ünd"] * 700 + ["w " * 3_000_000]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": pa.array(texts, kind), "learn": [True] * len(texts)})
    stretches = list(pylm.stretches_of([batch.slice(3, 2000), batch.slice(2003)]))
    words = [[*(t or "").encode().lower().split()] for t in texts[3:]]
    assert [w for s in stretches for a in s.words for w in a.cast(pa.large_binary()).to_pylist()] == [w for text in words for w in text]
    assert [n for s in stretches for n in s.sizes()] == [len(text) + 1 for text in words]
    assert [d for s in stretches for d in s.documents] == list(range(3, len(texts)))
