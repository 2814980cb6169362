from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
import xxhash

from tallyhouse.llm import simhash
from tallyhouse.llm.queries import op12_simhash_near_duplicates
from tests.llm.helpers import SMALL, by, documents, whole, with_clashes

SPACES = " \t\n\x0b\x0c\r"


def plain_fingerprint(text, size=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(" " if c in SPACES else c for c in low).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxhash.xxh64(" ".join(words[k : k + size]).encode(), seed=42).intdigest() for k in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=4):
    """``prints``: doc_id to fingerprint."""
    ids = sorted(prints)
    root = {d: d for d in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in itertools.combinations(ids, 2):
        if (prints[x] ^ prints[y]).bit_count() <= radius:
            a, b = top(x), top(y)
            root[max(a, b)] = min(a, b)
    return {d: top(d) for d in ids}


def test_every_difference_within_the_radius_is_covered():
    for radius, family in ((1, 0), (2, 0), (3, 1), (4, 0), (4, 1), (4, 2)):
        own = [m & (2**64 - 1) for m in simhash.masks(radius, family)]
        assert len(own) == 2 ** (radius + 1) - 1
        draw = random.Random(radius)
        differences = [sum(1 << k for k in draw.sample(range(64), radius)) for _ in range(20_000)]
        assert all(any(not m & d for m in own) for d in differences)
        assert all(20 <= m.bit_count() <= 44 for m in own) or radius < 3


def test_every_two_places_are_covered_and_no_mask_is_empty():
    own = [m & (2**64 - 1) for m in simhash.masks(2)]
    assert all(own)
    assert all(any(not m & (1 << x | 1 << y) for m in own) for x, y in itertools.combinations(range(64), 2))


def test_fingerprints_equal_plain_ones():
    draw = random.Random(3)
    texts = [None, "", " \n\t", "One", "one two three", "a b c d", "A B\tC\nD e", "ä Ä    x y z"]
    texts += [" ".join(draw.choice(["ab", "Cd", "e", "é"]) for _ in range(draw.randrange(60))) for _ in range(60)]
    for text in texts:
        assert simhash.fingerprint(text, 4) & (2**64 - 1) == plain_fingerprint(text)


def test_blocks_do_not_change_a_long_text(monkeypatch):
    text = " ".join(f"w{k % 977}" for k in range(5000))
    whole_print = simhash.fingerprint(text, 4)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text, 4) == whole_print
    assert whole_print & (2**64 - 1) == plain_fingerprint(text)


def test_query_equals_brute_force(spark):
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in whole("documents")}
    roots = plain_components(prints)
    found = by(op12_simhash_near_duplicates(spark, SMALL).collect())
    assert {d: (r["fingerprint"], r["component_id"]) for d, r in found.items()} == {d: (f"{p:016x}", roots[d]) for d, p in prints.items()}
    assert len(set(roots.values())) < len(roots)


def chained(draw, count):
    """Fingerprints in chains and in a ball: each new one moves some bits of one made before."""
    made = [draw.getrandbits(64) for _ in range(4)]
    made += [made[0] ^ sum(1 << place for place in draw.sample(range(64), 2)) for _ in range(count)]
    while len(made) < 2 * count:
        moved = draw.choice(made)
        for place in draw.sample(range(64), draw.randrange(1, 7)):
            moved ^= 1 << place
        made.append(moved)
    return made


@pytest.mark.parametrize("bucket_size", [60, 2048])
def test_links_connect_what_brute_force_connects(spark, bucket_size):
    made = sorted(set(chained(random.Random(bucket_size), 300)))
    signed = np.array(made, dtype=np.uint64).view(np.int64).tolist()
    distinct = spark.createDataFrame([(f,) for f in signed], "f bigint")
    links = [(r.a, r.b) for r in simhash.covered_links(distinct, 4, bucket_size).collect()]
    place = {f: k for k, f in enumerate(signed)}
    assert all((made[place[a]] ^ made[place[b]]).bit_count() <= 4 for a, b in links)
    expected = plain_components(dict(enumerate(made)))
    root = list(range(len(made)))
    for _ in range(len(made)):
        before = list(root)
        for a, b in links:
            low = min(root[place[a]], root[place[b]])
            root[place[a]] = root[place[b]] = low
        if root == before:
            break
    assert dict(enumerate(root)) == expected


def test_odd_rows(spark):
    text = "one two three four five six seven"
    rows = [(5, text), (9, text.upper()), (3, None), (4, ""), (8, " \n"), (None, text), (None, "alone by itself here now"), (6, "x"), (6, text), (5, text)]
    df = with_clashes(documents(spark, rows), "f", "id", "bucket", "root", "a", "b", "component", "fingerprint", "component_id")
    found = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_near_duplicates(df, 4).collect()), key=repr)
    same, alone, zero, x = (f"{plain_fingerprint(t):016x}" for t in (text, "alone by itself here now", "", "x"))
    expected = [(5, same, 5)] * 2 + [(9, same, 5), (6, same, 5), (None, same, 5), (None, alone, None), (6, x, 6)]
    expected += [(3, zero, 3), (4, zero, 3), (8, zero, 3)]
    assert found == sorted(expected, key=repr)
    assert simhash.simhash_near_duplicates(df.limit(0)).collect() == []
