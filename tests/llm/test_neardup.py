from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyhouse.llm import neardup
from tallyhouse.llm.common import word_hashes
from tallyhouse.llm.components import components
from tallyhouse.llm.queries import op2_minhash_near_duplicates
from tests.llm.helpers import SMALL, by, documents, whole, with_clashes


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < size else [tuple(words[k : k + size]) for k in range(len(words) - size + 1)])


def brute_force(rows, size, percent):
    """Components by comparing all pairs that share a shingle."""
    sets = {row[0]: shingles(row[1], size) for row in rows}
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for doc, own in sets.items():
        for shingle in own:
            lists[shingle].append(doc)
    for doc, own in sets.items():
        shared = Counter()
        for shingle in own:
            shared.update(lists[shingle])
        for other, n in shared.items():
            if other > doc and 100 * n >= percent * (len(own) + len(sets[other]) - n):
                low, high = sorted((root(doc), root(other)))
                parent[high] = low
    return {doc: (len(own), root(doc), root(doc) == doc) for doc, own in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in whole("documents")]
    assert result(op2_minhash_near_duplicates(spark, SMALL)) == brute_force(rows, 4, 80)


def test_chains_and_large_groups_equal_brute_force(spark, monkeypatch):
    """Near copies of near copies around the threshold, in tiles so small that groups are cut."""
    monkeypatch.setattr(neardup, "PART_DOCUMENTS", 32)
    draw = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    rows, doc = [], 0
    for group in range(6):
        base = [draw.choice(words) for _ in range(draw.choice([40, 90]))]
        for _ in range(60):
            text = list(base)
            for _ in range(draw.randrange(1, 6)):
                text[draw.randrange(len(text))] = draw.choice(words)
            rows.append((doc, " ".join(text)))
            doc += 7
            if draw.random() < 0.2:
                base = text
    rows += [(doc + k, " ".join(draw.choice(words) for _ in range(50))) for k in range(50)]
    draw.shuffle(rows)
    assert result(neardup.near_duplicates(documents(spark, rows), 4, 80)) == brute_force(rows, 4, 80)


def test_links_of_a_tile_span_all_linked_pairs():
    draw = random.Random(4)
    base = [f"v{draw.randrange(500)}" for _ in range(60)]
    texts = []
    for _ in range(80):
        text = list(base)
        for _ in range(draw.randrange(4)):
            text[draw.randrange(60)] = f"x{draw.randrange(10_000)}"
        texts.append(" ".join(text))
    hashes = word_hashes()
    sets = [neardup.shingle_set(t.encode().split(), 5, hashes) for t in texts]
    forest = neardup.Forest(len(sets))
    for a, b in neardup.links_of_tile(sets, 80, neardup.COORDINATES, neardup.AGREE):
        assert forest.join(a, b)
    expected = brute_force(list(enumerate(texts)), 5, 80)
    same = defaultdict(set)
    for k, root in enumerate(forest.roots()):
        same[root].add(k)
    assert sorted(map(sorted, same.values())) == sorted(
        sorted(k for k in expected if expected[k][1] == root) for root in {v[1] for v in expected.values()}
    )


def test_overlap_and_signature():
    one, other = np.array([1, 5, 9], dtype=np.uint64), np.array([5, 9, 10, 12], dtype=np.uint64)
    assert neardup.overlap(one, other) == 2 == neardup.overlap(other, one)
    many = np.arange(5000, dtype=np.uint64)
    assert (neardup.signature(many, 64) == np.minimum(neardup.signature(many[:700], 64), neardup.signature(many[700:], 64))).all()


def test_odd_rows(spark):
    text = "one two three four five six seven eight"
    rows = [(9, text), (3, text.upper()), (4, None), (5, ""), (6, " \n "), (7, "one two"), (8, "One  two"), (None, text), (3, text.upper())]
    df = with_clashes(documents(spark, rows))
    found = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df, 4).collect()), key=repr)
    assert found == sorted(
        [(9, 5, 3, False), (3, 5, 3, True), (3, 5, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True)]
        + [(7, 1, 7, True), (8, 1, 7, False), (None, 5, None, True)],
        key=repr,
    )
    assert neardup.near_duplicates(df.limit(0), 4).collect() == []


def test_one_doc_id_with_several_texts_is_one_node(spark):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    found = neardup.near_duplicates(documents(spark, [(1, a), (5, a), (5, b), (7, b)]), 4).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (5, 1), (5, 1), (7, 1)]


def test_components_of_paths_stars_and_self_links(spark):
    draw = random.Random(1)
    path = list(range(1000, 1200))
    draw.shuffle(path)
    links = list(zip(path, path[1:])) + [(5, k) for k in range(6, 300)] + [(7000, 7000), (None, 4)]
    draw.shuffle(links)
    found = {r.id: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {k: 1000 for k in path} | {k: 5 for k in range(5, 300)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_result_has_one_row_for_each_document(spark):
    assert len(by(op2_minhash_near_duplicates(spark, SMALL).collect())) == len(whole("documents"))


@pytest.mark.parametrize("bits", [64, 16])
def test_strangers_make_no_family(spark, bits):
    """Documents of 300 shingles without a common one: with whole coordinates no two meet, with short ones all become one family."""
    draw = np.random.default_rng(5)
    values = draw.integers(0, 2**64 // 300, size=(3000, neardup.COORDINATES), dtype=np.uint64) >> np.uint64(64 - bits)
    rows = [(k, row) for k, row in enumerate(values.view(np.int64).tolist())]
    sets = spark.createDataFrame(rows, "id long, signature array<bigint>")
    found = neardup.families(sets, neardup.COORDINATES, neardup.AGREE).groupBy("root").count().collect()
    if bits == 64:
        assert found == []
    else:
        assert max(r["count"] for r in found) > 2500
