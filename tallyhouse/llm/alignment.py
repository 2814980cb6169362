"""Alignment of two tokenizers' ids over the same text.

Both token sequences are laid over the bytes of a space and the text. Where a token of either side ends at the same byte,
the text is cut; between two cuts lies a *group* of tokens of both sides, and every two that share a byte are linked.

For a text: the cumulative ends of each side go into a dictionary from end to index; the ends of one side that are found
in the other's dictionary are the cuts, in order; they slice both lists of ids into groups, and links are made group by group.

For the corpus: texts are taken in blocks of bounded bytes, and cut into *runs*, a space and what follows up to the next one
behind a character that is no white space. No token of either side reaches over such a place, and the tokens of a run do
not depend on its neighbours, so each different run of a block is encoded and laid out once, together with others; a
text's groups and links are those of its runs in order. A block counts its pairs once and keeps the links of its runs, by
the pair's place in its own list of pairs, and the runs of its texts in a file of the shared folder; only the lists of
pairs are summed up over the corpus, so a pair that every text has travels once a block. The sums come back to the block,
where links look them up by place.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, islice, repeat

import numpy as np
import public_tokenizers
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm import files
from tallyhouse.llm.common import Columns, map_columns, new_folder, stored

#: Ranks of the byte-level side, which are its ids, and the pieces of the other side.
RANKS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Bytes of text in a block; one longer text is a block by itself.
BLOCK_BYTES = 8 << 20
#: A block also ends with the text that brings its different runs to so many, as a task holds them.
BLOCK_RUNS = 1 << 19
#: Characters of runs that are encoded and laid out together, or one longer run.
STRETCH = 1 << 16
#: Where runs begin: no match of the pattern has a space behind a character that is no white space, nor does what follows
#: change the matches before. Python's white space includes the pattern's.
RUNS = re.compile(r"(?<=\S) ")
#: A pair is the first id times this and the second id.
SECOND = 1 << 32

#: Pairs of a block, with links of each, where the links of its runs and the runs of its texts lie, and how many runs a text has.
BLOCK = T.StructType(
    [
        T.StructField("block", T.StringType(), False),
        T.StructField("file", T.StringType(), False),
        T.StructField("begin", T.LongType(), False),
        T.StructField("size", T.LongType(), False),
        T.StructField("doc_id", T.ArrayType(T.LongType()), False),
        *[T.StructField(c, T.ArrayType(T.LongType()), False) for c in ("n_a", "n_b", "n_groups", "n_links")],
        T.StructField("groups_sha256", T.ArrayType(T.StringType()), False),
        T.StructField("runs", T.ArrayType(T.LongType()), False),
        T.StructField("pairs", T.ArrayType(T.LongType()), False),
        T.StructField("links", T.ArrayType(T.LongType()), False),
    ]
)
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *[T.StructField(c, T.LongType(), False) for c in (*COUNTS, "n_best", "count_sum")],
        T.StructField("groups_sha256", T.StringType(), False),
    ]
)


class Side:
    """One tokenizer: ids of texts, and for each id its bytes and their number."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)

    def covers(self, ids: list[int], data: bytes) -> bool:
        return b"".join(map(self.tokens.__getitem__, ids)) == data

    def ends(self, ids: np.ndarray) -> list[int]:
        return np.cumsum(self.lengths[ids]).tolist()


class ByteLevel(Side):
    """Byte-level BPE; the vocabulary is also given as ranks, by which the pairs are merged.

    Every byte is a token, so the tokens of any text spell it.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        super().__init__(tokens)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(" " + text), dtype=np.int64)


class Pieces(Side):
    """Pieces with byte fallback; the library puts the space in front by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        super().__init__([self._bytes(k) for k in range(size)])
        #: Whether runs are encoded each for itself: merges (their scores are whole numbers, unlike probabilities) make
        #: pieces only, and none has a space behind another character.
        self.merges_stay_in_runs = all(self.model.get_score(k) % 1 == 0 and not RUNS.search(self._piece(k)) for k in range(size))
        #: A piece's mark is a space, so a text that has the mark itself is not spelled.
        self.mark_is_space = not self.model.is_unknown(self.model.piece_to_id("▁"))

    def _piece(self, k: int) -> str:
        return self.model.id_to_piece(k).replace("▁", " ")

    def _bytes(self, k: int) -> bytes:
        piece = self._piece(k)
        return bytes([int(piece[1:-1], 16)]) if self.model.is_byte(k) else piece.encode()

    def encode(self, text: str) -> np.ndarray | None:
        """Ids of a space and ``text``; None if they do not spell it."""
        ids = self.model.encode(text)
        spells = self.covers(ids, (" " + text).encode("utf-8", "surrogatepass"))
        return np.array(ids, dtype=np.int64) if spells else None


@lru_cache(maxsize=2)
def sides(ranks: str, pieces: str) -> tuple[ByteLevel, Pieces]:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return ByteLevel(public_tokenizers.path(ranks)), Pieces(public_tokenizers.path(pieces))


def cuts(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte where tokens of both sides end, in order: how many tokens of either side lie before it."""
    index_b = dict(zip(ends_b, count(1)))
    # The first side's ends come in order with their index, so what is met in the other's dictionary comes out sorted.
    met = np.fromiter(map(index_b.get, ends_a, repeat(0)), np.int64, len(ends_a))
    return np.flatnonzero(met) + 1, met[met > 0]


def linked(ends_a: list[int], ends_b: list[int], a: int, to_a: int, b: int, to_b: int) -> Iterator[tuple[int, int]]:
    """Overlapping tokens of one group, whose tokens are ``a`` to ``to_a`` and ``b`` to ``to_b``."""
    while a < to_a and b < to_b:
        yield a, b
        if ends_a[a] < ends_b[b]:
            a += 1
        elif ends_b[b] < ends_a[a]:
            b += 1
        else:
            a, b = a + 1, b + 1


def links(ends_a: list[int], ends_b: list[int], cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked tokens of both sides, group by group."""
    from_a, from_b = np.concatenate([[0], cut_a[:-1]]), np.concatenate([[0], cut_b[:-1]])
    in_a, in_b = cut_a - from_a, cut_b - from_b
    # One token on either side is linked with all of the other's.
    plain = (in_a == 1) | (in_b == 1)
    many = np.where(plain, np.maximum(in_a, in_b), 0)
    first = np.cumsum(many) - many
    offset = np.arange(int(many.sum())) - np.repeat(first, many)
    of_a = np.repeat(from_a, many) + np.where(np.repeat(in_a == 1, many), 0, offset)
    of_b = np.repeat(from_b, many) + np.where(np.repeat(in_b == 1, many), 0, offset)
    crossed = np.flatnonzero(~plain)
    if not len(crossed):
        return of_a, of_b
    more = [
        pair
        for a, to_a, b, to_b in zip(from_a[crossed].tolist(), cut_a[crossed].tolist(), from_b[crossed].tolist(), cut_b[crossed].tolist())
        for pair in linked(ends_a, ends_b, a, to_a, b, to_b)
    ]
    extra = np.array(more, dtype=np.int64).reshape(-1, 2)
    return np.concatenate([of_a, extra[:, 0]]), np.concatenate([of_b, extra[:, 1]])


@lru_cache(maxsize=1)
def spelled(size: int) -> np.ndarray:
    """Each id in decimal with a comma, bar or semicolon behind it, as eight bytes filled up with zeros."""
    return np.array([[f"{k}{mark}" for k in range(size)] for mark in ",|;"], dtype="S8").view("<u8")


def written(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group, first side first, each followed by its mark."""
    in_a, in_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    ids = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    marks = np.zeros(len(ids), dtype=np.int64)
    ids[np.arange(len(ids_a)) + np.repeat(cut_b - in_b, in_a)] = ids_a
    ids[np.arange(len(ids_b)) + np.repeat(cut_a, in_b)] = ids_b
    marks[cut_a + cut_b - in_b - 1] = 1
    marks[cut_a + cut_b - 1] = 2
    # Seven digits and a mark are eight bytes.
    size = 1 << int(ids.max()).bit_length()
    data = spelled(max(size, 1 << 16))[marks, ids].view(np.uint8)
    return data[data != 0].tobytes()[:-1]


class Aligned:
    """The alignment of one text; ``a`` and ``b`` are the ids, ``cut_a`` and ``cut_b`` the tokens before each cut."""

    def __init__(self, one: Side, other: Side, a: np.ndarray, b: np.ndarray):
        self.a, self.b = a, b
        ends_a, ends_b = one.ends(a), other.ends(b)
        self.ends_a = np.array(ends_a, dtype=np.int64)
        self.cut_a, self.cut_b = cuts(ends_a, ends_b)
        self.of_a, of_b = links(ends_a, ends_b, self.cut_a, self.cut_b)
        self.pairs = self.a[self.of_a] * SECOND + self.b[of_b]

    def groups(self) -> bytes:
        return written(self.a, self.b, self.cut_a, self.cut_b)


def runs_of(text: str, other: Pieces) -> list[str]:
    """The runs of a space and ``text``, each without its first space. White space at the end stays with what it follows."""
    runs = RUNS.split(text) if other.merges_stay_in_runs else [text]
    if len(runs) > 1 and not runs[-1].strip():
        runs[-2:] = [" ".join(runs[-2:])]
    return runs


def stretches(runs: list[str]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for k, run in enumerate(runs, 1):
        size += len(run)
        if size >= STRETCH:
            yield begin, k
            begin, size = k, 0
    if begin < len(runs):
        yield begin, len(runs)


def joined(arrays: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, dtype=kind)


class Runs:
    """Different runs, each with its counts, its groups written out and its links; ``spelled`` tells which have tokens."""

    def __init__(self, one: ByteLevel, other: Pieces, runs: list[str]):
        self.one, self.other, self.runs = one, other, runs
        self.spelled = np.zeros(len(runs), dtype=bool)
        self.counts = {c: np.zeros(len(runs), dtype=np.int64) for c in COUNTS}
        self.groups = [b""] * len(runs)
        held = [found for begin, to in stretches(runs) for found in self._aligned(begin, to)]
        #: The run of each link, in order of runs, the different pairs, and the place in these of each link's pair.
        self.of = joined([of for of, _, _ in held], np.int32)
        self.pairs, place = np.unique(joined([pairs for _, pairs, _ in held], np.int64), return_inverse=True)
        ends = np.cumsum([len(pairs) for _, pairs, _ in held], dtype=np.int64).tolist()
        self.place = joined([place[f:t][own].astype(np.int32) for f, t, (_, _, own) in zip([0, *ends], ends, held)], np.int32)

    def _encoded(self, begin: int, to: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """Runs that spell their text, with the second side's ids; one that does not is found by halving, and left out."""
        ids = self.other.encode(" ".join(self.runs[begin:to]))
        if ids is not None:
            yield begin, to, ids
        elif to - begin > 1:
            middle = (begin + to) // 2
            yield from self._encoded(begin, middle)
            yield from self._encoded(middle, to)

    def _aligned(self, begin: int, to: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Lay out some runs as one text: the run of each link, the pairs, and the place in these of each link's pair."""
        # White space at a text's end would be matched with a run behind it, so nothing may follow there.
        last = [k for k, run in enumerate(self.runs[begin:to], begin + 1) if not self.other.merges_stay_in_runs or run[-1].isspace()]
        parts = [p for f, t in zip([begin, *last], [*last, to]) if f < t for p in self._encoded(f, t)]
        if not parts:
            return
        number = np.concatenate([np.arange(f, t) for f, t, _ in parts])
        a = np.concatenate([self.one.encode(" ".join(self.runs[f:t])) for f, t, _ in parts])
        found = Aligned(self.one, self.other, a, np.concatenate([b for *_, b in parts]))
        ends = np.cumsum([len(self.runs[k].encode("utf-8", "surrogatepass")) + 1 for k in number.tolist()])
        # Both sides end at the end of a run, so there is a cut.
        to_a = np.searchsorted(found.ends_a, ends) + 1
        to_group = np.searchsorted(found.cut_a, to_a) + 1
        of = np.searchsorted(to_a, found.of_a, side="right")
        data = found.groups() + b";"
        mark = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == ord(";"))[to_group - 1].tolist()
        for k, f, t in zip(number.tolist(), [-1, *mark], mark):
            self.groups[k] = data[f + 1 : t]
        before = (to_a, found.cut_b[to_group - 1], to_group, np.cumsum(np.bincount(of, minlength=len(number))))
        for c, values in zip(COUNTS, before):
            self.counts[c][number] = np.diff(values, prepend=0)
        self.spelled[number] = True
        order = np.argsort(of, kind="stable")
        pairs, place = np.unique(found.pairs[order], return_inverse=True)
        yield number[of[order]].astype(np.int32), pairs, place.astype(np.int32)


def summed(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of as many consecutive values as ``sizes`` says."""
    sums, ends = np.concatenate([[0], np.cumsum(values, dtype=np.int64)]), np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def aligned_blocks(documents: DataFrame, folder: str, ranks: str, pieces: str, block_bytes: int) -> DataFrame:
    """Align every text; a stored row for each block."""

    def work(batches: Iterator[Columns]) -> Iterator[Columns]:
        one, other = sides(ranks, pieces)
        name, out, begin = f"links-{uuid.uuid4().hex}.bin", None, 0
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def numbered() -> defaultdict[str, int]:
            found: defaultdict[str, int] = defaultdict()
            found.default_factory = found.__len__
            return found

        numbers = numbered()

        def block() -> Columns:
            nonlocal out, begin, docs, held, size, numbers
            runs = Runs(one, other, list(numbers))
            sizes, every = np.array([len(h) for h in held], dtype=np.int64), np.concatenate(held)
            # A text has no tokens if one of its runs has none.
            spells = summed(~runs.spelled[every], sizes) == 0
            every, sizes = every[np.repeat(spells, sizes)], np.where(spells, sizes, 0)
            times = np.bincount(every, minlength=len(numbers))
            number = np.zeros(len(runs.pairs), dtype=np.int64)
            np.add.at(number, runs.place, times[runs.of])
            groups, spelled_out = map(runs.groups.__getitem__, every.tolist()), []
            for n in sizes.tolist():
                spelled_out.append(hashlib.sha256(b";".join(islice(groups, n))).hexdigest() if n else "")
            kept = ([len(numbers), len(runs.place)], runs.counts["n_links"], runs.place, every)
            data = zstandard.compress(np.concatenate([np.asarray(v, dtype="<u4") for v in kept]), 1)
            out = out or files.writer(folder, name)
            out.write(data)
            done = {"block": [f"{name}:{begin}"], "file": [name], "begin": [begin], "size": [len(data)], "doc_id": [docs]}
            done |= {c: [summed(values[every], sizes)] for c, values in runs.counts.items()}
            done |= {"groups_sha256": [spelled_out], "runs": [sizes], "pairs": [runs.pairs], "links": [number]}
            begin += len(data)
            docs, held, size, numbers = [], [], 0, numbered()
            return done

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                none = not text or (other.mark_is_space and "▁" in text)
                runs = [] if none else runs_of(text, other)
                docs.append(doc)
                held.append(np.fromiter(map(numbers.__getitem__, runs), np.int32, len(runs)))
                size += len(text or "")
                if size >= block_bytes or len(numbers) >= BLOCK_RUNS:
                    yield block()
        if docs:
            yield block()
        if out:
            out.close()

    return stored(map_columns(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), BLOCK, work), "alignment-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair, total, best``: links of each pair of ids in the corpus, and whether no pair of its second id has more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "links")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.links").alias("n"))
    totals = stored(each.groupBy("pair").agg(F.sum("n").alias("total")), "alignment-pairs")
    second = F.col("pair").bitwiseAND(F.lit(SECOND - 1))
    # A row for each id of the second vocabulary at most.
    highest = totals.groupBy(second.alias("b")).agg(F.max("total").alias("highest"))
    return totals.join(highest, second == F.col("b")).select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))


def scored(blocks: DataFrame, folder: str) -> DataFrame:
    """One row for each text: its counts, and over its links the corpus counts and the best of their second id."""
    places = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    # The total, negative where it is not the best, so one number travels back for each pair.
    signed = F.when(F.col("best"), F.col("total")).otherwise(-F.col("total"))
    back = places.join(stored(pair_counts(blocks).select("pair", signed.alias("signed")), "alignment-totals"), "pair")
    back = back.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", "signed"))).alias("found"))
    back = back.select("block", F.transform("found", lambda x: x["signed"]).alias("signed"))
    joint = blocks.drop("pairs", "links").join(back, "block", "left")

    def work(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for k, file in enumerate(batch["file"]):
                signed = np.array(batch["signed"][k] or [], dtype=np.int64)
                data = files.reader(folder, file).read_at(batch["size"][k], batch["begin"][k])
                kept = np.frombuffer(zstandard.decompress(data), dtype="<u4")
                runs, found = kept[:2].tolist()
                many, place, every = np.split(kept[2:].astype(np.int64), [runs, runs + found])
                values, sizes = signed[place], np.array(batch["runs"][k], dtype=np.int64)
                best, total = (summed(summed(v, many)[every], sizes) for v in (values > 0, np.abs(values)))
                yield {c: batch[c][k] for c in ("doc_id", *COUNTS, "groups_sha256")} | {"n_best": best, "count_sum": total}

    return map_columns(joint.select("file", "begin", "size", "doc_id", *COUNTS, "groups_sha256", "runs", "signed"), RESULT, work)


def align_tokenizers(documents: DataFrame, ranks: str = RANKS, pieces: str = PIECES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row of ``documents``.

    ``n_best`` counts the links whose pair of ids is linked as often in the corpus as any pair with this second id,
    ``count_sum`` sums the corpus' links of each link's pair. ``groups_sha256`` is the hash of all groups, written out.

    Null and empty texts, and texts that a side's tokens do not spell byte for byte, have no tokens: zeros and an empty
    string. Strings of special tokens are plain text. A text of any length is taken whole: a task holds it, or a block
    of texts, with its runs. Repeated rows count and come back as often as they are there; a null doc_id
    stays null. Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    folder = new_folder(documents.sparkSession, "alignment-links")
    return scored(aligned_blocks(documents, folder, ranks, pieces, block_bytes), folder)
