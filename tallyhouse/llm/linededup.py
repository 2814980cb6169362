"""Line deduplication by overlapping windows of three lines, in DataFrame functions only.

Each run of three consecutive lines is a window, known by two 64-bit hashes.
A window found more than once in the corpus stays where it occurs first, by
doc_id and then by position; everywhere else its lines are covered.
Covered lines of all windows are merged and left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored

LINES = 3


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows_of(rows: DataFrame, size: int) -> DataFrame:
    """Every window of each row's ``_line_parts``: position and two hashes. Windows without a word are left out.

    The lines are laid beside themselves, moved by one and by two, so a window is one element and nothing
    looks back into the array.
    """
    count = F.greatest(F.size("_line_parts") - (size - 1), F.lit(0))
    moved = [F.slice("_line_parts", k + 1, count).alias(f"l{k}") for k in range(size)]
    each = rows.select("_line_doc", "_line_text", F.posexplode(F.arrays_zip(*moved)).alias("at", "w"))
    parts = [F.col(f"w.l{k}") for k in range(size)]
    wordless = F.concat(*parts).rlike(r"\A[\x20\x09-\x0D]*\z")
    return each.where(~wordless).select(
        "_line_doc", "_line_text", "at", F.xxhash64(*parts).alias("one"), F.xxhash64(F.lit(1), *parts[::-1]).alias("two")
    )


def deduplicate_lines(documents: DataFrame, size: int = LINES) -> DataFrame:
    """``documents`` with later occurrences of repeated windows cut out of ``text``.

    Adds ``n_lines`` (before) and ``n_removed``; all other columns stay as they are.

    A null text stays null and has no lines. Texts of fewer than ``size`` lines have no
    window and stay whole; of a text whose lines are all covered, the empty text
    is left. Rows that repeat both doc_id and text share the same decisions, rows
    that repeat only the doc_id are told apart by their text. A null doc_id
    comes before all others. An empty table stays empty. A text of any length is taken whole. Other columns
    travel under names of their own, so theirs may be anything; ``n_lines`` and ``n_removed`` of the input give way to the new ones.
    """
    names = [c for c in documents.columns if c not in ("n_lines", "n_removed")]
    documents = documents.select(*names)
    hidden = {c: f"_line_own_{k}" for k, c in enumerate(names) if c not in ("doc_id", "text")}
    documents = documents.withColumnsRenamed(hidden)
    others = [c for c in documents.columns if c != "text"]
    # The lines travel instead of the text, so they are made once.
    rows = documents.select(*others, F.xxhash64("text").alias("_line_text"), lines_of(F.col("text")).alias("_line_parts"))
    windows = stored(
        windows_of(rows.where("_line_parts is not null").withColumnRenamed("doc_id", "_line_doc"), size), "line-windows"
    )
    place = F.struct("_line_doc", "_line_text", "at")
    repeated = stored(
        windows.groupBy("one", "two").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n"),
        "repeated-windows",
    )
    later = windows.join(repeated, ["one", "two"]).where(place > F.col("first"))
    covered = later.groupBy("_line_doc", "_line_text").agg(F.collect_set("at").alias("_line_starts"))
    covered = covered.withColumnRenamed("_line_text", "_line_same")
    found = rows.join(
        covered.hint("shuffle_hash"),
        F.col("doc_id").eqNullSafe(F.col("_line_doc")) & F.col("_line_text").eqNullSafe(F.col("_line_same")),
        "left",
    )
    lines = F.col("_line_parts")
    gone = F.flatten(F.transform("_line_starts", lambda at: F.sequence(at, at + (size - 1))))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    cut = F.array_join(F.transform(left, lambda at: F.get(lines, at)), "\n")
    touched = F.col("_line_starts").isNotNull()
    text = F.when(touched, cut).otherwise(F.array_join(lines, "\n")).alias("text")
    return found.select(
        *[text if c == "text" else F.col(hidden.get(c, c)).alias(c) for c in names],
        F.when(lines.isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(touched, F.size(F.array_distinct(gone))).otherwise(0).cast("long").alias("n_removed"),
    )
