from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import tokenfile
from tallyhouse.llm.queries import op6_packed_token_files
from tests.llm.helpers import SMALL, documents, whole, with_clashes


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(tokenfile.VOCABULARY))


def expected(rows, library):
    found, start = [], 0
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        found.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return found


def test_query_equals_the_library(spark, library):
    rows = sorted((r["doc_id"], r["text"]) for r in whole("documents"))
    df = op6_packed_token_files(spark, SMALL)
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, df.collect())) == expected(rows, library)


def test_stretches_equal_whole_texts(library):
    pieces = ["a", "The", " ", "  ", "\n", "\t", "é", "É", "Ñ", "ß", "́", "漢字", "İ", "Σ", "'s", "'", "|", "1", "12", ",", ".", "<|endoftext|>", "ﬁ", " ", "\x1c", "ı", "ª", "한", "ᆫ", "ŉ", "ſ"]
    own, draw = tokenfile.codec(tokenfile.VOCABULARY), random.Random(8)
    for _ in range(2500):
        text = "".join(draw.choice(pieces) for _ in range(draw.randrange(25)))
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("bits", [1, 5, 8, 15, 16, 17, 31, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype(np.uint32)
    data = tokenfile.pack(ids, bits)
    assert len(data) == (1000 * bits + 7) // 8
    assert (tokenfile.unpack(data, 1000, bits) == ids).all()


def test_bits():
    assert [tokenfile.bits_for(n) for n in (1, 2, 3, 256, 257, 49_408, 65_537)] == [1, 1, 2, 8, 9, 16, 17]


@pytest.mark.parametrize("bits", [13, 16])
def test_random_access(tmp_path, monkeypatch, bits):
    monkeypatch.setattr(tokenfile, "READ_IDS", 30)
    draw = random.Random(bits)
    docs = [(draw.choice([None, k, -k]), np.array([draw.randrange(1 << 13) for _ in range(draw.choice([0, 1, 9, 100]))], dtype=np.uint32)) for k in range(60)]
    out = tokenfile.TokenWriter(str(tmp_path), "t", bits, block=7)
    for doc, ids in docs:
        out.add(doc, ids)
    out.close()
    file = tokenfile.TokenReader(str(tmp_path), "t")
    every = np.concatenate([ids for _, ids in docs])
    for start in range(0, len(every), 17):
        assert file.read(start, start + 40).tolist() == every[start : start + 40].tolist()
    assert [(d, i.tolist()) for d, _, i in file.each()] == [(d, i.tolist()) for d, i in docs]
    with pytest.raises(ValueError):
        tokenfile.TokenWriter(str(tmp_path), "u", 4).add(1, np.array([16], dtype=np.uint32))


def test_odd_rows(spark, library):
    rows = [(7, "b a"), (None, "null id"), (3, None), (4, ""), (4, ""), (9, "long text, " * 100_000), (-5, "x")]
    df = with_clashes(documents(spark, rows), "start", "part", "file")
    found = sorted(map(tuple, tokenfile.token_files(df).collect()), key=lambda r: r[1])
    assert found == expected(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), library)
    assert tokenfile.token_files(df.limit(0)).collect() == []
