from __future__ import annotations

import random
import re

from tallyhouse.llm import linededup
from tallyhouse.llm.queries import op7_line_dedup
from tests.llm.helpers import SMALL, documents, whole, with_clashes


def brute_force(rows):
    """Rows of ``(doc_id, text)`` without repeats: what stays of each text."""
    seen, found = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        if text is None:
            found.append((doc, 0, 0, None))
            continue
        lines, gone = text.split("\n"), set()
        for at in range(len(lines) - 2):
            window = tuple(lines[at : at + 3])
            if not re.search(r"[^\x20\x09-\x0D]", "".join(window)):
                continue
            if window in seen:
                gone.update(range(at, at + 3))
            seen.add(window)
        left = "\n".join(line for k, line in enumerate(lines) if k not in gone)
        found.append((doc, len(lines), len(gone), left))
    return sorted(found, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_removed", "text").collect()), key=repr)


def test_query_equals_brute_force(spark):
    found = got(op7_line_dedup(spark, SMALL))
    assert found == brute_force([(r["doc_id"], r["text"]) for r in whole("documents")])
    assert any(row[2] for row in found)


def test_few_different_lines_equal_brute_force(spark):
    draw = random.Random(12)
    rows = [(k, "\n".join(draw.choice(["a", "b", "c", "", " ", "long line é"]) for _ in range(draw.randrange(9)))) for k in range(300)]
    assert got(linededup.deduplicate_lines(documents(spark, rows))) == brute_force(rows)


def test_no_python_runs(spark):
    plan = op7_line_dedup(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_odd_rows(spark):
    text = "one\ntwo\nthree\nfour"
    rows = [(5, text), (None, text), (6, None), (7, ""), (8, "one\ntwo"), (9, "\n\n\n\n"), (10, "one\ntwo\nthree\n")]
    names = ("at", "one", "two", "first", "w", "n", "_line_text", "_line_doc", "_line_parts", "_line_starts", "_line_same")
    df = with_clashes(documents(spark, rows), *names)
    out = linededup.deduplicate_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_removed"]
    assert got(out) == brute_force(rows)
    assert {r.at for r in out.collect()} == {"clash"}
    assert linededup.deduplicate_lines(df.limit(0)).collect() == []


def test_repeated_rows_share_decisions(spark):
    text = "one\ntwo\nthree"
    found = got(linededup.deduplicate_lines(documents(spark, [(1, text), (1, text), (2, text), (2, text), (2, "x\n" + text)])))
    assert found == sorted([(1, 3, 0, text)] * 2 + [(2, 3, 3, "")] * 2 + [(2, 4, 3, "x")], key=repr)


def test_a_very_long_text(spark):
    text = "\n".join(f"line {k % 3000}" for k in range(30_000))
    assert got(linededup.deduplicate_lines(documents(spark, [(1, text)]))) == brute_force([(1, text)])
