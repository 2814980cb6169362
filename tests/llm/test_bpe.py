from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tallyhouse.llm import bpe
from tallyhouse.llm.queries import op1_byte_bpe
from tests.llm.helpers import SMALL, by, documents, whole, with_clashes


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(bpe.VOCABULARY, public_tokenizers.PATTERN)


def test_equals_the_library_on_odd_texts(codec, reference):
    pieces = ["a", "the", "aaaa", " ", "  ", "\n", "\t", "é", "́", "漢字", "😀", "'s", "'S", "12", "|!", " ", "　", "\x1c", "İ", "<|endoftext|>"]
    draw = random.Random(5)
    for _ in range(1500):
        text = "".join(draw.choice(pieces) for _ in range(draw.randrange(25)))
        ids = codec.encode(text)
        assert ids == reference.encode_ordinary(text), text
        assert codec.decode(ids) == text.encode()


def test_appends_and_edits_equal_a_fresh_table(codec, reference):
    draw = random.Random(6)
    for _ in range(120):
        data = bytes(draw.choice(b"abthe ing.") for _ in range(150))
        table = bpe.Prefixes(codec.vocabulary, data[:60])
        table.append(data[60:])
        assert table.tokens() == reference._core_bpe.encode_single_piece(data)
        start = draw.randrange(150)
        put = bytes(draw.choice(b"abthe") for _ in range(draw.randrange(5)))
        table.edit(start, min(150, start + draw.randrange(5)), put)
        assert table.last == bpe.Prefixes(codec.vocabulary, table.data).last


def test_an_edit_recomputes_only_its_surroundings(codec):
    table = bpe.Prefixes(codec.vocabulary, b"the quick brown fox jumps over the lazy dog " * 200)
    assert table.edit(100, 101, b"q") < 1000


def test_vocabulary_must_be_a_trained_one():
    ranks = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError):
        bpe.Vocabulary({k: v for k, v in ranks.items() if v})
    with pytest.raises(ValueError):
        bpe.Vocabulary(ranks | {b"abc": 256})


def test_query_equals_the_library(spark, reference):
    found = by(op1_byte_bpe(spark, SMALL).collect())
    rows = whole("documents")
    assert len(found) == len(rows)
    for row in rows:
        text = row["text"] or ""
        ids = reference.encode_ordinary(text)
        got = found[row["doc_id"]]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(spark):
    long = "word and more " * 100_000
    df = with_clashes(documents(spark, [(1, None), (2, ""), (2, ""), (None, "a b"), (5, long)]))
    rows = bpe.encode_documents(df).collect()
    assert len(rows) == 5
    nothing = hashlib.sha256(b"").hexdigest()
    assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows if r.doc_id in (1, 2)] == [(0, nothing, nothing)] * 3
    assert [r.decoded_sha256 for r in rows if r.doc_id == 5] == [hashlib.sha256(long.encode()).hexdigest()]
    assert bpe.encode_documents(df.limit(0)).collect() == []
