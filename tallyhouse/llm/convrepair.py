"""Repair of damaged conversations by the cheapest edits, the least audit among equals.

A repaired conversation is empty, or an optional system turn and then user and assistant in turn. Every row is
kept (K), given another role (R) or deleted (D), and empty turns are inserted (I); blank and repeated rows can only be
deleted. A node is a place between two rows together with the role that came last; an arc is an edit.

1. Rows are put in order by one range shuffle of small rows (faults and role initials, no texts) and written as
   *pieces*: a byte for each row, ``PIECE`` rows of one conversation at most.
2. Cost DP, backwards over a piece: the cheapest way on from each node. It goes by one number for a row, since costs
   that differ by a constant behave alike. A conversation of several pieces is cut: each piece becomes a 4 x 4 matrix of
   least costs, and the products of the matrices behind a piece give the costs at its end.
3. Path ranking: only arcs on cheapest ways are left. Nodes are ranked by the letter of their least arc, then by the
   ranks of pairs of nodes that lie 1, 2, 4, ... letters apart, so after k rounds by the least audit of 2^k letters.
   An edit's letter decides its end, so one pointer a node and length is enough. Arcs are chosen by letter
   and rank of the end; the doubled pointers lay the chosen path out, all letters of all conversations at once.
4. Texts are shuffled once, to their conversation's audit, and edited in one stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import Columns, map_columns, stored, wide

#: Rows of one conversation in a piece, and rows whose paths are laid out together.
PIECE, TOGETHER = 1 << 16, 1 << 14
#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Letters in ASCII order; their places are the arcs of a node.
LETTERS = "DIKR"
D, I, K, R = range(4)
#: The role that came last: none yet, system, user, assistant. No way on has FAR or more.
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 50
#: Role that may follow a state by rerole or insertion.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Codes: initial (s, u, a, another) + 4 x fault (none, blank, duplicate, truncated).
FAULTS = ("none", "blank", "duplicate", "truncated")
LEGAL = ("su", "ua", "au")
FOLLOWS = np.array([[x + y in LEGAL for y in "sua?"] for x in "sua?"])
#: Cost at the end of a conversation, with the turns that still have to come.
AT_END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, int, int, int]


def kept_state(state: int, initial: int) -> int | None:
    """State after a row that is kept as it is, if it may follow."""
    if initial == 0:
        return SYSTEM if state == START else None
    return initial + 1 if initial + 1 == NEXT[state] else None


def inserted(costs: list[int]) -> list[int]:
    """Costs of a place once turns may be inserted there; two are ever useful."""
    for _ in range(2):
        costs = [min(own, INSERT + costs[NEXT[s]]) for s, own in enumerate(costs)]
    return costs


@lru_cache(maxsize=1 << 16)
def step(after: Vector, code: int) -> tuple[int, Vector, tuple[int, ...]]:
    """One row of the DP: what is taken out, costs before the row, and for each state and letter the state behind the arc.

    ``after`` are the costs behind the row. States of arcs off the cheapest ways are -1; the end of an I arc is before the row.
    """
    initial, fault = code % 4, code // 4
    arcs, costs = [[-1] * 4 for _ in range(4)], [FAR] * 4
    more = TRUNCATED * (fault == 3)
    reach = [[FAR] * 4 for _ in range(4)]
    for s in range(4):
        reach[s][D] = DELETE + after[s]
        if fault not in (1, 2):
            to = kept_state(s, initial)
            if to is not None:
                reach[s][K] = more + after[to]
            reach[s][R] = REROLE + more + after[NEXT[s]]
        costs[s] = min(reach[s])
    costs = inserted(costs)
    for s in range(4):
        reach[s][I] = INSERT + costs[NEXT[s]]
        ends = (s, NEXT[s], kept_state(s, initial), NEXT[s])
        for letter in range(4):
            if reach[s][letter] == costs[s] < FAR:
                arcs[s][letter] = ends[letter]
    least = min(costs)
    return least, tuple(c - least if c < FAR // 2 else FAR for c in costs), tuple(x for row in arcs for x in row)


def matrix(codes: bytes) -> list[int]:
    """Least cost from each state before the piece to each state behind it, row by row; no insertion behind it."""
    columns = []
    for t in range(4):
        taken, vector = 0, tuple(0 if s == t else FAR for s in range(4))
        for code in reversed(codes):
            least, vector, _ = step(vector, code)
            taken += least
        columns.append([FAR if c >= FAR // 2 else c + taken for c in vector])
    return [columns[t][s] for s in range(4) for t in range(4)]


def before(piece: list[int], after: Vector) -> Vector:
    """Costs before a piece from those behind it."""
    return tuple(min(piece[4 * s + t] + after[t] for t in range(4)) for s in range(4))


def choices(codes: bytes, after: Vector, last: bool) -> tuple[np.ndarray, int, Vector]:
    """Cheapest arcs of all nodes (places x states x letters: state of the end or -1), and the costs before the piece."""
    least = min(after)
    taken, vector = least, tuple(c - least for c in after)
    arcs = []
    for code in reversed(codes):
        down, vector, own = step(vector, code)
        taken += down
        arcs.append(own)
    # Behind the last row of a conversation only insertions are left; in other pieces they belong to the next one.
    end = [[-1] * 4 for _ in range(4)]
    if last:
        for s in (SYSTEM, USER):
            end[s][I] = NEXT[s]
    laid = np.array([*arcs[::-1], tuple(x for row in end for x in row)], dtype=np.int64).reshape(-1, 4, 4)
    return laid, taken, tuple(c + taken for c in vector)


def least_paths(options: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The least audit from each start, and the node where it ends. ``options`` (nodes x letters) holds ends or -1."""
    nodes = np.arange(len(options))
    there = options >= 0
    ends = ~there.any(axis=1)
    # Audits of one letter: the least arc's. An end is below every letter and leads to itself.
    letter = np.where(ends, 0, there.argmax(axis=1))
    rank = np.where(ends, 0, letter + 1)
    pointer = np.where(ends, nodes, options[nodes, letter])
    while not ends[pointer].all():
        # Ranks of pairs are the ranks of audits of twice the length.
        rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
    # Now ranks tell whole audits apart: the arc is taken by its letter, then by the rank of its end.
    value = np.arange(1, 5) * (rank.max() + 1) + rank[np.where(there, options, 0)]
    letter = np.where(there, value, np.iinfo(np.int64).max).argmin(axis=1)
    doubled = [np.where(ends, nodes, options[nodes, letter])]
    length = (~ends).astype(np.int64)
    while not ends[doubled[-1]].all():
        length = length + length[doubled[-1]]
        doubled.append(doubled[-1][doubled[-1]])
    lengths = length[starts]
    begin = np.cumsum(lengths) - lengths
    offset = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
    at = np.repeat(starts, lengths)
    for k, leap in enumerate(doubled):
        at = np.where(offset >> k & 1, leap[at], at)
    audits = np.frombuffer(LETTERS.encode(), dtype=np.uint8)[letter[at]].tobytes()
    return [audits[b : b + n] for b, n in zip(begin.tolist(), lengths.tolist())], doubled[-1][starts]


def solved(pieces: list[tuple[bytes, Vector, bool]], entries: tuple[int, ...]) -> list[tuple[list[bytes], list[int], int]]:
    """For each piece: the audit and the last state from every entry state, and the cost from the first of them."""
    options, starts, firsts, costs = [], [], [], []
    first = 0
    for codes, after, last in pieces:
        laid, _, ahead = choices(codes, after, last)
        place = first + 4 * np.arange(len(laid))[:, None, None]
        # Insertions stay at their place, other edits go on to the next.
        onward = place + 4 * (np.arange(4) != I)
        options.append(np.where(laid >= 0, onward + laid, -1).reshape(-1, 4))
        starts += [first + s for s in entries]
        firsts.append(first)
        costs.append(ahead[entries[0]])
        first += 4 * len(laid)
    audits, ends = least_paths(np.concatenate(options), np.array(starts))
    states = (ends % 4).tolist()
    n = len(entries)
    return [(audits[k * n : k * n + n], states[k * n : k * n + n], cost) for k, cost in enumerate(costs)]


def counted(codes: bytes) -> dict[str, int]:
    """Rows of each fault, and neighbours whose initials may not meet, inside a piece."""
    values = np.frombuffer(codes, dtype=np.uint8)
    faults = np.bincount(values // 4, minlength=4).tolist()
    initials = values % 4
    return {**dict(zip(FAULTS, faults)), "illegal": int((~FOLLOWS[initials[:-1], initials[1:]]).sum())}


def named(column: str) -> Column:
    """A conversation's key for joins: never null, a null apart from every value."""
    return F.when(F.col(column).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(column).cast("string")))


ORDER = ("turn", "role", "one", "two")


def marked(conversations: DataFrame) -> DataFrame:
    """``conv, conv_id, turn, role, text`` with hashes of the text (``one``, ``two``), which order rows of one turn and role.

    Null roles and texts are one space.
    """
    rows = conversations.select(
        named("conv_id").alias("conv"), "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    return rows.withColumns({"one": F.xxhash64("text"), "two": F.xxhash64(F.lit(1), "text")})


SMALL = T.StructType([T.StructField("conv", T.StringType(), False), T.StructField("piece", T.LongType(), False), T.StructField("codes", T.BinaryType(), False)])


def pieces_of(rows: DataFrame, piece_rows: int = PIECE) -> DataFrame:
    """``conv, piece, codes`` in order: the codes of each conversation's rows."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    truncated = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)
    # Written before rows are numbered, so a repeated task finds the same numbers.
    small = stored(
        rows.select("conv", *ORDER, initial.alias("initial"), blank.alias("blank"), truncated.alias("truncated"), F.monotonically_increasing_id().alias("row")),
        "conversation-rows",
    )
    place = F.struct(F.col("turn").isNotNull().alias("dated"), "turn", "row")
    again = ["conv", "role", "one", "two"]
    first = small.groupBy(*again).agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    first = stored(first, "conversation-repeats")
    duplicate = F.coalesce(place > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), 1).when(duplicate, 2).when(F.col("truncated"), 3).otherwise(0)
    coded = small.join(first, again, "left").select("conv", *ORDER, "row", (F.col("initial") + 4 * fault).cast("int").alias("code"))

    def laid(batches: Iterator[Columns]) -> Iterator[Columns]:
        conv, codes, number = None, bytearray(), TaskContext.get().partitionId() << 32
        for batch in batches:
            out: Columns = {"conv": [], "piece": [], "codes": []}
            for own, code in zip(batch["conv"], batch["code"]):
                if own != conv or len(codes) >= piece_rows:
                    if codes:
                        out["conv"].append(conv), out["piece"].append(number), out["codes"].append(bytes(codes))
                        number += 1
                    conv, codes = own, bytearray()
                codes.append(code)
            yield out
        if codes:
            yield {"conv": [conv], "piece": [number], "codes": [bytes(codes)]}

    ordered = coded.repartitionByRange(wide(rows.sparkSession), "conv", *ORDER, "row").sortWithinPartitions("conv", *ORDER, "row")
    return stored(map_columns(ordered.select("conv", "code"), SMALL, laid), "conversation-pieces")


COUNTS = (*FAULTS[1:], "illegal")
REPAIR = T.StructType(
    [T.StructField("conv", T.StringType(), False), *[T.StructField(c, T.LongType(), False) for c in (*COUNTS, "cost")], T.StructField("audit", T.StringType(), False)]
)
PART = T.StructType(
    [
        T.StructField("conv", T.StringType(), False),
        T.StructField("piece", T.LongType(), False),
        *[T.StructField(c, T.LongType(), False) for c in (*COUNTS, "first", "last")],
        T.StructField("matrix", T.ArrayType(T.LongType()), False),
    ]
)
JOINT = T.StructType(
    [T.StructField("conv", T.StringType(), False), *[T.StructField(c, T.LongType(), False) for c in (*COUNTS, "cost")],
     T.StructField("pieces", T.ArrayType(T.LongType()), False), T.StructField("after", T.ArrayType(T.ArrayType(T.LongType())), False)]
)
WAYS = T.StructType(
    [T.StructField("conv", T.StringType(), False), T.StructField("piece", T.LongType(), False),
     T.StructField("audits", T.ArrayType(T.StringType()), False), T.StructField("states", T.ArrayType(T.LongType()), False)]
)


def whole_repairs(batches: Iterator[Columns]) -> Iterator[Columns]:
    """Conversations of one piece."""
    for batch in batches:
        held, rows = [], 0
        for k, (conv, codes) in enumerate(zip(batch["conv"], batch["codes"])):
            held.append((conv, codes))
            rows += len(codes)
            if rows >= TOGETHER or k + 1 == len(batch["conv"]):
                out: Columns = {c: [] for c in REPAIR.names}
                for (conv, codes), (audits, _, cost) in zip(held, solved([(codes, AT_END, True) for _, codes in held], (START,))):
                    counts = counted(codes)
                    for c in COUNTS:
                        out[c].append(counts[c])
                    out["conv"].append(conv), out["cost"].append(cost), out["audit"].append(audits[0].decode())
                yield out
                held, rows = [], 0


def measured(batches: Iterator[Columns]) -> Iterator[Columns]:
    """Counts and cost matrix of each piece."""
    for batch in batches:
        out: Columns = {c: [] for c in PART.names}
        for conv, piece, codes in zip(batch["conv"], batch["piece"], batch["codes"]):
            row = {**counted(codes), "conv": conv, "piece": piece, "first": codes[0] % 4, "last": codes[-1] % 4, "matrix": matrix(codes)}
            for c in PART.names:
                out[c].append(row[c])
        yield out


def joined_up(batches: Iterator[Columns]) -> Iterator[Columns]:
    """Costs behind every piece of a conversation, from the last one to the first; its counts and its cost."""
    for batch in batches:
        out: Columns = {c: [] for c in JOINT.names}
        for conv, parts in zip(batch["conv"], batch["parts"]):
            vector, after = AT_END, []
            for part in reversed(parts):
                after.append(list(vector))
                vector = before(part["matrix"], vector)
            for c in COUNTS:
                out[c].append(sum(part[c] for part in parts))
            out["illegal"][-1] += sum(not FOLLOWS[x["last"], y["first"]] for x, y in zip(parts, parts[1:]))
            out["conv"].append(conv), out["cost"].append(vector[START])
            out["pieces"].append([part["piece"] for part in parts]), out["after"].append(after[::-1])
        yield out


def ways_through(batches: Iterator[Columns]) -> Iterator[Columns]:
    """The least audit of each piece from each of the four states."""
    for batch in batches:
        out: Columns = {c: [] for c in WAYS.names}
        for conv, piece, codes, after, last in zip(*(batch[c] for c in ("conv", "piece", "codes", "after", "is_last"))):
            audits, states, _ = solved([(codes, tuple(after), last)], (START, SYSTEM, USER, ASSISTANT))[0]
            out["conv"].append(conv), out["piece"].append(piece)
            out["audits"].append([a.decode() for a in audits]), out["states"].append(states)
        yield out


ENTRY = T.StructType([T.StructField("conv", T.StringType(), False), T.StructField("pieces", T.ArrayType(T.LongType()), False), T.StructField("entries", T.ArrayType(T.LongType()), False)])


def entered(batches: Iterator[Columns]) -> Iterator[Columns]:
    """The state in which the path enters each piece."""
    for batch in batches:
        out: Columns = {c: [] for c in ENTRY.names}
        for conv, parts in zip(batch["conv"], batch["parts"]):
            state, entries = START, []
            for part in parts:
                entries.append(state)
                state = part["states"][state]
            out["conv"].append(conv), out["pieces"].append([p["piece"] for p in parts]), out["entries"].append(entries)
        yield out


def audits_of(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv, blank, duplicate, truncated, illegal, cost`` for each conversation, and ``conv, piece, audit`` in pieces."""
    # Conversations that go on over a piece or a range: a few for each partition, and the long ones.
    many = stored(pieces.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv"), "conversation-long")
    alone = stored(map_columns(pieces.join(many, "conv", "left_anti").select("conv", "codes"), REPAIR, whole_repairs), "conversation-repairs")
    rest = stored(pieces.join(many, "conv", "left_semi"), "conversation-long-pieces")

    def in_order(df: DataFrame, *columns: str) -> DataFrame:
        """A row for each conversation with one small entry a piece."""
        return df.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("piece", *columns))).alias("parts"))

    parts = map_columns(rest, PART, measured)
    joint = stored(map_columns(in_order(parts, *COUNTS, "first", "last", "matrix"), JOINT, joined_up), "conversation-joint")
    behind = joint.select("conv", F.size("pieces").alias("n"), F.posexplode(F.arrays_zip("pieces", "after")).alias("k", "p"))
    behind = behind.select("conv", F.col("p.pieces").alias("piece"), F.col("p.after").alias("after"), (F.col("k") + 1 == F.col("n")).alias("is_last"))
    ways = stored(map_columns(rest.join(behind, ["conv", "piece"]), WAYS, ways_through), "conversation-ways")
    entry = map_columns(in_order(ways, "states"), ENTRY, entered)
    entry = entry.select("conv", F.explode(F.arrays_zip("pieces", "entries")).alias("p")).select("conv", "p.*")
    chosen = ways.join(entry.withColumnRenamed("pieces", "piece"), ["conv", "piece"])
    chosen = chosen.select("conv", "piece", F.get("audits", F.col("entries").cast("int")).alias("audit"))
    summary = alone.drop("audit").unionByName(joint.select("conv", *COUNTS, "cost"))
    return summary, alone.select("conv", F.lit(0).cast("long").alias("piece"), "audit").unionByName(chosen)


def edited(batches: Iterator[Columns]) -> Iterator[tuple[str, str, list[tuple[str, str, str | None, str | None]]]]:
    """Conversation by conversation, a bounded number of edits at a time: ``(conv, audit, [(letter, row's role, role, text)])``.

    Takes rows sorted by conversation, the audit's pieces before the rows. The audit comes with the last part of a
    conversation, and is empty before. Held at a time are one audit and the edits of a batch.
    """
    conv, audit, at, state, out = None, [], 0, START, []

    def letters_until_row(whole: str) -> None:
        nonlocal at, state
        while at < len(whole) and whole[at] == "I":
            state = NEXT[state]
            out.append(("I", None, NAMES[state], ""))
            at += 1

    whole = ""
    for batch in batches:
        for own, part, role, text in zip(batch["conv"], batch["audit"], batch["role"], batch["text"]):
            if own != conv:
                if conv is not None:
                    whole = whole or "".join(audit)
                    letters_until_row(whole)
                    yield conv, whole, out
                conv, audit, whole, at, state, out = own, [], "", 0, START, []
            if part is not None:
                audit.append(part)
                continue
            whole = whole or "".join(audit)
            letters_until_row(whole)
            letter = whole[at]
            at += 1
            if letter == "D":
                out.append((letter, role, None, None))
            elif letter == "R":
                state = NEXT[state]
                out.append((letter, role, NAMES[state], text))
            else:
                state = kept_state(state, "sua".find(role[:1]))
                out.append((letter, role, role, text))
        if out:
            yield conv, "", out
            out = []
    if conv is not None:
        whole = whole or "".join(audit)
        letters_until_row(whole)
        yield conv, whole, out


REPAIRED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("place", T.LongType(), False),
        T.StructField("edit", T.StringType(), False),
        T.StructField("old_role", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
DIGEST = T.StructType([T.StructField("conv", T.StringType(), False), T.StructField("audit", T.StringType(), False), T.StructField("repaired_sha256", T.StringType(), False)])


def repaired_rows(batches: Iterator[Columns]) -> Iterator[Columns]:
    """Every edit as a row; ``place`` counts the edits of a conversation from 0."""
    conv, place = None, 0
    for own, _, edits in edited(batches):
        if own != conv:
            conv, place = own, 0
        number = int(own[1:]) if own else None
        letters, old, roles, texts = zip(*edits) if edits else ((),) * 4
        yield {"conv_id": [number] * len(edits), "place": list(range(place, place + len(edits))), "edit": letters, "old_role": old, "role": roles, "text": texts}
        place += len(edits)


def digests(batches: Iterator[Columns]) -> Iterator[Columns]:
    """Audit and hash of each repaired conversation; the text runs through the hash."""
    conv, running, begun = None, hashlib.sha256(), False
    out: Columns = {c: [] for c in DIGEST.names}
    for own, audit, edits in edited(batches):
        if own != conv:
            conv, running, begun = own, hashlib.sha256(), False
        for letter, _, role, text in edits:
            if letter != "D":
                running.update(("\n" if begun else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                begun = True
        if audit:
            out["conv"].append(own), out["audit"].append(audit), out["repaired_sha256"].append(running.hexdigest())
            if len(out["conv"]) >= 4096:
                yield out
                out = {c: [] for c in DIGEST.names}
    yield out


def with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows of texts behind the audits of their conversation, conversations dealt out whole and streamed in order."""
    texts = rows.select("conv", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("piece"), *ORDER, "text", F.lit(None).cast("string").alias("audit"))
    empty = [F.lit(None).cast(kind).alias(c) for c, kind in zip((*ORDER, "text"), ("long", "string", "long", "long", "string"))]
    joint = audits.select("conv", F.lit(0).alias("kind"), "piece", *empty, "audit").unionByName(texts)
    dealt = joint.repartition(wide(rows.sparkSession), "conv").sortWithinPartitions("conv", "kind", "piece", *ORDER)
    return dealt.select("conv", "audit", "role", "text")


def repair(conversations: DataFrame, piece_rows: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """What is wrong with each conversation and what it costs to mend, and the edits that do so.

    Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` for each conv_id, and
    ``conv_id, place, edit, old_role, role, text`` for each edit in order (a deleted row has no new role or text).

    Rows go by turn, a null turn first; rows of one turn by role and by hash of the text, repeated rows follow one another
    and all but the first are duplicates. A null text or role is one space, a null conv_id is a conversation of its own. An
    empty text is blank. ``conv_id`` is an integer. Other columns are ignored, whatever their names. Empty tables give empty results.

    Texts of any length pass as they are. Of a long conversation, any task holds ``piece_rows`` codes, one small
    entry a piece, or, where texts are edited in order, its audit and a batch of rows; its hash is made in one stream.
    """
    rows = marked(conversations)
    return repaired_from(rows, conversations, piece_rows)


def repaired_from(rows: DataFrame, every: DataFrame, piece_rows: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """:func:`repair` of marked ``rows``, with a result for each conv_id of ``every``."""
    summary, audits = audits_of(pieces_of(rows, piece_rows))
    dealt = with_audits(rows, audits)
    turns = rows.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    found = every.select("conv_id", named("conv_id").alias("conv")).distinct()
    for part in (turns, summary, map_columns(dealt, DIGEST, digests)):
        found = found.join(part, "conv", "left")
    nothing = hashlib.sha256().hexdigest()
    result = found.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *COUNTS, "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
    return result, map_columns(dealt, REPAIRED, repaired_rows)


def damaged(conversations: DataFrame) -> DataFrame:
    """Damage by the remainder of each row's ``conv_id:turn``, for trials: rows go, lose text or marks, repeat, change role."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(parts[0], F.lit(":"), parts[1]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """The trial: damage ``conversations``, repair them, and report on every conv_id."""
    return repaired_from(marked(damaged(conversations)), conversations)[0]
