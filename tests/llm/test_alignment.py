from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyhouse.llm import alignment
from tallyhouse.llm.queries import op11_tokenizer_alignment
from tallyhouse.llm.tokenfile import VISIBLE
from tests.llm.helpers import SMALL, documents, whole, with_clashes


@pytest.fixture(scope="module")
def libraries():
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def spans(tokens):
    end, out = 0, []
    for token in tokens:
        out.append((end, end + len(token)))
        end += len(token)
    return out


def plain(texts, libraries):
    """For each text: counts, links as pairs of ids, groups written out. By overlap of every two tokens nearby."""
    one, other = libraries
    byte = {chr(c): b for b, c in VISIBLE.items()}
    found = []
    for text in texts:
        a = one.encode(" " + text, add_special_tokens=False) if text else None
        b = other.encode(text) if text else []
        bytes_a = [bytes(byte.get(c, ord(c) & 255) for c in t) for t in a.tokens] if a else []
        bytes_b = [bytes([int(other.id_to_piece(k)[3:5], 16)]) if other.is_byte(k) else other.id_to_piece(k).replace("▁", " ").encode() for k in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            found.append((0, 0, 0, [], ""))
            continue
        at_a, at_b = spans(bytes_a), spans(bytes_b)
        pairs, low = [], 0
        for x, (begin, end) in enumerate(at_a):
            while at_b[low][1] <= begin:
                low += 1
            y = low
            while y < len(at_b) and at_b[y][0] < end:
                pairs.append((a.ids[x], b[y]))
                y += 1
        cut = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups, last = [], 0
        for c in cut:
            left = [str(i) for i, (s, e) in zip(a.ids, at_a) if last <= s and e <= c] if len(cut) < 400 else None
            right = [str(i) for i, (s, e) in zip(b, at_b) if last <= s and e <= c] if len(cut) < 400 else None
            groups.append(f"{','.join(left)}|{','.join(right)}" if left is not None else None)
            last = c
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if len(cut) < 400 else None
        found.append((len(a.ids), len(b), len(cut), pairs, digest))
    return found


def expected(texts, libraries):
    found = plain(texts, libraries)
    total = Counter(pair for *_, pairs, _ in found for pair in pairs)
    highest = Counter()
    for (_, b), n in total.items():
        highest[b] = max(highest[b], n)
    return [
        (n_a, n_b, n_groups, len(pairs), sum(total[p] == highest[p[1]] for p in pairs), sum(total[p] for p in pairs), digest)
        for n_a, n_b, n_groups, pairs, digest in found
    ]


def got(df):
    return [(r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)) for r in df.collect()]


def same(ours, theirs):
    assert ours[:6] == theirs[:6]
    assert theirs[6] is None or ours[6] == theirs[6]


def test_query_equals_brute_force(spark, libraries):
    rows = whole("documents")
    found = dict(got(op11_tokenizer_alignment(spark, SMALL)))
    assert len(found) == len(rows)
    for row, theirs in zip(rows, expected([r["text"] for r in rows], libraries)):
        same(found[row["doc_id"]], theirs)


ODD = [
    None, "", " ", "  two  spaces ", "<|endoftext|> <s> <unk>", "tab\tand\nlines\r\n", "naïve café 北京 🙂👍🏽 ‍", "▁own mark", "x" * 5000,
    "The quick brown fox jumps over it.", "don't we'll I'm 12345 3.14159", "नमस्ते दुनिया", "á é", "\x00\x01", "ﬁ ligature Ω", "The quick brown fox",
]


@pytest.mark.parametrize("block_bytes", [1, 300, alignment.BLOCK_BYTES])
def test_odd_texts_in_blocks_of_any_size(spark, libraries, block_bytes):
    draw = random.Random(1)
    texts = ODD + ["".join(draw.choice("ab éß北🙂 .\n") for _ in range(draw.randrange(80))) for _ in range(40)] + ODD[:4]
    df = with_clashes(documents(spark, list(enumerate(texts))), "block", "pairs", "links", "file", "n_a", "pair", "total", "place")
    found = sorted(got(alignment.align_tokenizers(df, block_bytes=block_bytes)))
    assert len(found) == len(texts)
    for (doc, ours), (k, theirs) in zip(found, enumerate(expected(texts, libraries))):
        assert doc == k
        same(ours, theirs)


def test_ranks_encode_as_the_library_does(libraries):
    draw = random.Random(4)
    texts = [t for t in ODD if t] + ["".join(chr(draw.choice([32, 65, 0x3B1, 0x4E2D, 0x1F600, 10, 0x300, 0x2028, 0xA0, 39, 115])) for _ in range(60)) for _ in range(300)]
    texts += [r["text"] for r in whole("documents") if r["text"]]
    one = alignment.sides(alignment.RANKS, alignment.PIECES)[0]
    assert [one.encode(t).tolist() for t in texts] == [libraries[0].encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_links_of_groups_are_all_overlaps():
    draw = random.Random(6)
    for _ in range(300):
        total = draw.randrange(1, 30)
        ends_a, ends_b = (sorted({*draw.sample(range(1, total + 1), draw.randrange(total)), total}) for _ in range(2))
        cut_a, cut_b = alignment.cuts(ends_a, ends_b)
        found = alignment.links(ends_a, ends_b, cut_a, cut_b)
        spans_a, spans_b = list(zip([0, *ends_a], ends_a)), list(zip([0, *ends_b], ends_b))
        every = [(x, y) for x, (s, e) in enumerate(spans_a) for y, (t, f) in enumerate(spans_b) if s < f and t < e]
        assert sorted(zip(*(v.tolist() for v in found))) == every


def test_repeated_rows_null_ids_and_empty_tables(spark, libraries):
    rows = [(1, "The same text."), (1, "The same text."), (None, "The same text."), (2, None)]
    df = documents(spark, rows)
    theirs = expected([t for _, t in rows], libraries)
    found = sorted(got(alignment.align_tokenizers(df)), key=repr)
    assert found == sorted([(d, t) for (d, _), t in zip(rows, theirs)], key=repr)
    assert alignment.align_tokenizers(df.limit(0)).collect() == []
    assert sorted(got(alignment.align_tokenizers(documents(spark, [(1, None), (2, "")])))) == [(d, (0, 0, 0, 0, 0, 0, "")) for d in (1, 2)]


SPACES = [" ", "  ", "\n", " \n", "\n ", "\t ", "\r\n", "\x1c ", "\x85", "\xa0 ", "　 ", "​ "]


def spaced(draw, words):
    return "".join(draw.choice([*words, *SPACES, " ", " ", " "]) for _ in range(draw.randrange(1, 30)))


def test_runs_have_the_ids_of_the_text():
    one, other = alignment.sides(alignment.RANKS, alignment.PIECES)
    assert other.merges_stay_in_runs
    draw = random.Random(8)
    texts = [t for t in ODD if t and "▁" not in t] + [spaced(draw, ["word", "two,", "() {\r", "'s", "12", "é", "北京", "🙂", "x.\ny"]) for _ in range(2000)]
    for text in texts:
        runs = alignment.runs_of(text, other)
        assert " ".join(runs) == text
        for side in (one, other):
            assert np.concatenate([side.encode(r) for r in runs]).tolist() == side.encode(text).tolist()


def test_texts_with_odd_white_space_and_runs_that_do_not_spell(spark, libraries):
    draw = random.Random(9)
    texts = [spaced(draw, ["same", "the", "end.", "▁" if k % 7 == 0 else "no", "a▁b" if k % 11 == 0 else "é"]) for k in range(300)]
    found = sorted(got(alignment.align_tokenizers(documents(spark, list(enumerate(texts))))))
    theirs = expected(texts, libraries)
    assert {t[6] == "" for t in theirs} == {True, False}
    for (_, ours), other in zip(found, theirs, strict=True):
        same(ours, other)


class Counted:
    def __init__(self, side):
        self.side, self.characters = side, 0

    def __getattr__(self, name):
        return getattr(self.side, name)

    def encode(self, text):
        self.characters += len(text)
        return self.side.encode(text)


def test_a_block_encodes_repeated_runs_once(spark, tmp_path, monkeypatch):
    draw = random.Random(10)
    words = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(50)]
    texts = [" ".join(draw.choices(words, k=40)) for _ in range(100)]
    counted = [Counted(side) for side in alignment.sides(alignment.RANKS, alignment.PIECES)]
    monkeypatch.setattr(alignment, "sides", lambda *_: counted)
    monkeypatch.setattr(alignment, "stored", lambda found, _: found)
    monkeypatch.setattr(alignment, "map_columns", lambda df, schema, work: list(work(iter([{"doc_id": list(range(100)), "text": texts}]))))
    folder = tmp_path.as_uri()
    blocks = alignment.aligned_blocks(documents(spark, []), folder, alignment.RANKS, alignment.PIECES, alignment.BLOCK_BYTES)
    assert len(blocks) == 1
    for side in counted:
        assert side.characters < 2 * sum(map(len, words)) < sum(map(len, texts)) / 10


def test_pieces_that_reach_over_spaces_take_texts_whole(monkeypatch):
    one, other = alignment.sides(alignment.RANKS, alignment.PIECES)
    texts = ["two words here", "end \n", "▁ no", "x.\ny  z"]
    cut = [alignment.Runs(one, other, alignment.runs_of(t, other)) for t in texts]
    monkeypatch.setattr(other, "merges_stay_in_runs", False)
    assert [alignment.runs_of(t, other) for t in texts] == [[t] for t in texts]
    entire = alignment.Runs(one, other, texts)
    assert entire.spelled.tolist() == [True, True, False, True]
    for k, runs in enumerate(cut):
        if k != 2:
            assert {c: v[k] for c, v in entire.counts.items()} == {c: v.sum() for c, v in runs.counts.items()}
            assert entire.groups[k] == b";".join(runs.groups)
            assert sorted(entire.pairs[entire.place[entire.of == k]]) == sorted(runs.pairs[runs.place])
