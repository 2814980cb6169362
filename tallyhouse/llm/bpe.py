"""Byte-level BPE by prefix dynamic programming.

For a run of bytes, the BPE encoding of every prefix ends in one token, and
that token is the only one that is *compatible* with the encoding of what
comes before it. So a table of the last token of each prefix determines the
encoding of every prefix: walk back from the end. Appending bytes only adds
entries; after an edit, entries are recomputed from the edit on and the old
ones are taken over as soon as they can no longer differ.

Two tokens side by side are compatible when BPE of their joined bytes gives
the same two tokens. This holds if no merge across the seam is due before
the pieces at the seam are swallowed by the merges inside the two tokens.

Texts are cut by the tokenizer's pattern first; each match is a run of its
own. Ranks must be those of a trained vocabulary: all single bytes present and
every longer token the merge of two tokens of lower rank (checked on loading).
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyhouse.llm.common import Columns, Memo, map_columns, text_bytes

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Entries of the cache, and characters of the longest run that is kept in it.
CACHED, CACHED_CHARS = 600_000, 64
#: Compatibility verdicts kept at most.
VERDICTS = 500_000
NONE = -1


class Vocabulary:
    """Ranks of byte tokens, with what the compatibility test needs."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"single bytes without a rank: {missing[:5]}")
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank in sorted(self.token):
            token = self.token[rank]
            if len(token) > 1:
                left, right = self._halves(token, rank)
                self.halves[rank] = left, right
                self.joined[left, right] = rank
        #: Tokens read backwards, byte by byte: from node and byte to the next node, and the token that ends at a node.
        self.steps: dict[int, int] = {}
        self.ended: list[int] = [NONE]
        for token, rank in ranks.items():
            node = 0
            for byte in reversed(token):
                onward = self.steps.setdefault(node << 8 | byte, len(self.ended))
                if onward == len(self.ended):
                    self.ended.append(NONE)
                node = onward
            self.ended[node] = rank
        #: Verdicts by the first and the second token.
        self._verdicts: dict[int, dict[int, bool]] = {}
        self._room = VERDICTS

    def _halves(self, token: bytes, rank: int) -> tuple[int, int]:
        """The two tokens whose merge gives ``token``: merge lowest ranks first, below its own rank."""
        parts = [self.ranks[token[i : i + 1]] for i in range(len(token))]
        while len(parts) > 2:
            due = [(self.joined.get(pair, rank), i) for i, pair in enumerate(zip(parts, parts[1:]))]
            lowest, at = min(due)
            if lowest >= rank:
                raise ValueError(f"token {rank} is not the merge of two tokens of lower rank")
            parts[at : at + 2] = [lowest]
        if max(parts) >= rank:
            raise ValueError(f"token {rank} is not the merge of two tokens of lower rank")
        return parts[0], parts[1]

    def last_tokens(self, data: bytes, begin: int, last: list[int], stop: int | None = None) -> None:
        """Continue ``last``, the last token of each prefix, from ``begin`` on to ``stop`` or the end of ``data``.

        The last token of a prefix is the one token ending there that is compatible with the prefix before it; tokens
        are met from the shortest on by reading backwards.
        """
        ranks, steps, ended, verdicts = self.ranks, self.steps, self.ended, self._verdicts
        stop = len(data) if stop is None else stop
        # A prefix that is a token itself is its own last token, so the first ones need no look at what fits.
        while begin < stop:
            token = ranks.get(data[: begin + 1])
            if token is None:
                break
            last.append(token)
            begin += 1
        for end in range(begin, stop):
            node = 0
            for start in range(end, -1, -1):
                # A single byte is a token, so a node is there until one token has fitted.
                node = steps[node << 8 | data[start]]
                token = ended[node]
                if token >= 0:
                    if start == 0:
                        break
                    before = last[start - 1]
                    known = verdicts.get(before)
                    fits = None if known is None else known.get(token)
                    if fits is None:
                        fits = self.fits(before, token)
                        self._keep(before, token, fits)
                    if fits:
                        break
            last.append(token)

    def _keep(self, before: int, token: int, fits: bool) -> None:
        self._room -= 1
        if self._room < 0:
            self._verdicts.clear()
            self._room = VERDICTS
        self._verdicts.setdefault(before, {})[token] = fits

    def fits(self, first: int, second: int) -> bool:
        """Whether no merge across the seam of two tokens comes first.

        Takes the merges inside both tokens back, the latest first, and looks
        at the two pieces that meet at the seam each time: a merge of those
        is due if its rank is below that of the merge just taken back. For equal ranks
        merges go from left to right: the left token's own merge wins over
        one across the seam, the right token's own merge loses to it.
        """
        joined, halves, before = self.joined, self.halves, 1 << 60
        while True:
            across = joined.get((first, second))
            if across is not None and across < before:
                return False
            left, right = halves.get(first), halves.get(second)
            if left is not None and (right is None or first > second):
                before, first = first, left[1]
            elif right is not None:
                before, second = second + 1, right[0]
            else:
                return True


class Prefixes:
    """The last token of every prefix of a run of bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        """Add bytes at the end; entries of earlier prefixes stay."""
        old = len(self.data)
        self.data += data
        self.vocabulary.last_tokens(self.data, old, self.last)

    def edit(self, start: int, stop: int, data: bytes) -> int:
        """Replace the bytes from ``start`` to ``stop``; returns how many entries were computed anew.

        An entry depends on the bytes of one longest token and on the
        entries before them. So once the new entries equal the old ones over
        such a stretch behind the edit, all later ones are equal too.
        """
        tail_data, tail = self.data[stop:], self.last[stop:]
        self.data = self.data[:start] + data + tail_data
        last = self.last[:start]
        settled, behind, end = 0, start + len(data), start
        while end < len(self.data):
            if settled >= self.vocabulary.longest:
                last.extend(tail[end - behind :])
                break
            self.vocabulary.last_tokens(self.data, end, last, end + 1)
            end += 1
            settled = settled + 1 if end > behind and tail[end - behind - 1] == last[-1] else 0
        computed = end - start
        self.last = last
        return computed

    def tokens(self) -> list[int]:
        found, end = [], len(self.data)
        while end:
            token = self.last[end - 1]
            found.append(token)
            end -= len(self.vocabulary.token[token])
        return found[::-1]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class Codec:
    """Texts to ids and back.

    Most of a text is words that occur again and again, so ids are cached by match.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.matches = regex.compile(pattern).findall
        self.by_match = Memo(self._match, CACHED, CACHED_CHARS)

    def _match(self, match: str) -> bytes:
        data = text_bytes(match)
        # A token encodes itself: on loading its merges were seen to lead to it.
        rank = self.vocabulary.ranks.get(data)
        return array("I", Prefixes(self.vocabulary, data).tokens() if rank is None else [rank]).tobytes()

    def encode_packed(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.by_match.__getitem__, self.matches(text))) if text else b""

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_packed(text), dtype="<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.token.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(vocabulary: str, pattern: str) -> Codec:
    """The codec of a vocabulary file, made once in each Python worker."""
    return Codec(load_ranks(public_tokenizers.path(vocabulary)), pattern)


RESULT = T.StructType(
    [
        T.StructField("n_tokens", T.LongType(), False),
        T.StructField("ids_sha256", T.StringType(), False),
        T.StructField("decoded_sha256", T.StringType(), False),
    ]
)
IDS = T.StructField("token_ids", T.BinaryType(), False)


def encode_documents(
    documents: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    vocabulary: str = VOCABULARY,
    pattern: str = public_tokenizers.PATTERN,
    with_ids: bool = True,
) -> DataFrame:
    """Encode the ``text`` of each row, decode the ids again, and add digests of both.

    Returns the ``keep`` columns, ``token_ids`` (little-endian unsigned 32-bit
    integers; left out if ``with_ids`` is false), ``n_tokens``, ``ids_sha256``
    and ``decoded_sha256``. One pass over each partition, no shuffle.

    A null or empty text has no ids, and digests of nothing. Repeated rows give
    repeated results; an empty table an empty one. Other columns of the input
    are ignored, whatever their names. A text of any length is encoded whole.
    """
    schema = T.StructType([documents.schema[c] for c in keep] + ([IDS] if with_ids else []) + RESULT.fields)

    def encoded(batches: Iterator[Columns]) -> Iterator[Columns]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            out = {name: batch[name] for name in keep} | {name: [] for name in RESULT.names + [IDS.name]}
            for text in batch["text"]:
                packed = own.encode_packed(text)
                ids = np.frombuffer(packed, dtype="<u4").tolist()
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(own.decode(ids)).hexdigest())
                if with_ids:
                    out[IDS.name].append(packed)
            yield out

    return map_columns(documents.select(*dict.fromkeys([*keep, "text"])), schema, encoded)
