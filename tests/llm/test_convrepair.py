from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest

from tallyhouse.llm import convrepair
from tallyhouse.llm.queries import op13_conversation_repair
from tests.llm.helpers import SMALL, whole, with_clashes

TURNS = "conv_id bigint, turn bigint, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_audit(rows):
    """``rows``: (initial, fault) in order. The cheapest, then least way to the grammar's end, by plain recursion."""

    @lru_cache(maxsize=None)
    def best(i, state, added):
        ways = [(0, "")] if i == len(rows) and state in ("", "a") else []
        then = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        if added < 2:
            cost, audit = best(i, then, added + 1)
            ways.append((2 + cost, "I" + audit))
        if i < len(rows):
            initial, fault = rows[i]
            cost, audit = best(i + 1, state, 0)
            ways.append((3 + cost, "D" + audit))
            if fault in (0, 3):
                if initial == then or (initial == "s" and state == ""):
                    cost, audit = best(i + 1, initial, 0)
                    ways.append(((fault == 3) + cost, "K" + audit))
                cost, audit = best(i + 1, then, 0)
                ways.append((2 + (fault == 3) + cost, "R" + audit))
        return min(ways, default=(10**9, "~"))

    return best(0, "", 0)


def plain_repair(rows, every):
    found, groups = {}, defaultdict(list)
    for row in rows:
        groups[row[0]].append(row[1:])
    for conv in every:
        own = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, initials = set(), [], [role[:1] for _, role, _ in own]
        for _, role, text in own:
            body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append(1 if not WORD.search(text) else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
            seen.add((role, text))
        cost, audit = plain_audit(tuple(zip(initials, faults)))
        state, lines, at = "", [], 0
        for letter in audit:
            then = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            name = {"u": "user", "a": "assistant"}[then]
            if letter == "I":
                lines.append(name + ":")
                state = then
                continue
            _, role, text = own[at]
            at += 1
            if letter == "K":
                lines.append(f"{role}:{text}")
                state = role[:1]
            if letter == "R":
                lines.append(f"{name}:{text}")
                state = then
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        found[conv] = (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
    return found


def got(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_query_equals_brute_force(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in whole("conversations")]
    assert got(op13_conversation_repair(spark, SMALL)) == plain_repair(plain_damage(rows), {r[0] for r in rows})


def wild(draw, conversations, most):
    """Turns with gaps, repeats and other roles; one text for each turn and role, so rows of a turn have one order."""
    rows = []
    for conv in [None, *range(conversations)]:
        for _ in range(draw.randrange(most)):
            turn = draw.choice([None, *range(most)])
            role = draw.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = draw.choice(["Yes.", "no", "", None, " \n", "What? "])
            rows.append((conv, turn, role, text))
    unique = {r[:3]: r for r in rows}
    return [r for r in unique.values() for _ in range(draw.choice([1, 1, 1, 2]))]


@pytest.mark.parametrize("piece_rows", [1, 3, 1 << 16])
def test_wild_conversations_equal_brute_force_in_pieces_of_any_size(spark, piece_rows):
    rows = wild(random.Random(5), 120, 14)
    df = spark.createDataFrame(rows, TURNS)
    blanks = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    expected = plain_repair(blanks, {r[0] for r in rows})
    summary, edits = convrepair.repair(with_clashes(df, "conv", "one", "two", "row", "piece", "audit", "kind", "n", "first", "code"), piece_rows)
    assert got(summary) == expected
    lines = defaultdict(list)
    for r in edits.collect():
        lines[r.conv_id].append((r.place, r.edit, r.role, r.text))
    for conv, (*_, audit, digest) in expected.items():
        own = sorted(lines[conv], key=lambda x: x[0])
        assert [x[0] for x in own] == list(range(len(own)))
        assert "".join(x[1] for x in own) == audit
        assert hashlib.sha256("\n".join(f"{role}:{text}" for _, e, role, text in own if e != "D").encode()).hexdigest() == digest


def test_paths_of_many_conversations_laid_out_together():
    draw = random.Random(8)
    pieces = [bytes(draw.choice([0, 1, 2, 3, 5, 10, 13, 14, 1, 2]) for _ in range(draw.randrange(1, 40))) for _ in range(300)]
    for codes, (audits, _, cost) in zip(pieces, convrepair.solved([(p, convrepair.AT_END, True) for p in pieces], (0,))):
        assert (cost, audits[0].decode()) == plain_audit(tuple(("sua?"[c % 4], c // 4) for c in codes))


def test_matrices_give_the_costs_of_whole_pieces():
    draw = random.Random(9)
    for _ in range(100):
        codes = bytes(draw.randrange(16) for _ in range(draw.randrange(1, 30)))
        cut = draw.randrange(len(codes) + 1)
        vector = convrepair.AT_END
        for part in (codes[cut:], codes[:cut]):
            vector = convrepair.before(convrepair.matrix(part), vector) if part else vector
        assert vector == tuple(convrepair.choices(codes, convrepair.AT_END, True)[2])


def test_ranks_choose_the_least_of_equal_paths():
    # Node 0 reaches the end by "IK" or "KI"; both cost the same.
    options = np.array([[-1, 1, 2, -1], [-1, -1, 3, -1], [-1, 3, -1, -1], [-1, -1, -1, -1]])
    assert convrepair.least_paths(options, np.array([0, 2, 3])) == ([b"IK", b"I", b""], pytest.approx(np.array([3, 3, 3])))


def test_a_long_conversation_in_pieces(spark):
    draw = random.Random(2)
    rows = [(7, t, draw.choice(["user", "assistant", "system"]), f"text {draw.randrange(900)}" + draw.choice([".", "", "!"])) for t in range(3000)]
    summary, _ = convrepair.repair(spark.createDataFrame(rows, TURNS), 100)
    found = got(summary)[7]
    one = got(convrepair.repair(spark.createDataFrame(rows, TURNS))[0])[7]
    assert found == one and found[5] > 1000


def test_empty_tables_and_dropped_conversations(spark):
    df = spark.createDataFrame([], TURNS)
    summary, edits = convrepair.repair(df)
    assert summary.collect() == [] and edits.collect() == []
    assert convrepair.damaged_and_repaired(df).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = got(convrepair.damaged_and_repaired(spark.createDataFrame([(gone, 0, "user", "Hi.")], TURNS)))
    assert found == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_a_very_long_text(spark):
    text = "word " * 200_000 + "end."
    found = got(convrepair.repair(spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", "Fine.")], TURNS))[0])
    assert found[1][-2:] == ("KK", hashlib.sha256(f"user:{text}\nassistant:Fine.".encode()).hexdigest())
