"""Corpus cleaning: stages over the documents table, each reading what the one before it wrote.

Rows may repeat and any column may be null; each stage says what it makes of
them. Extra columns of the input travel along to the last stage. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm import bpe, decontam, linededup, neardup, quality
from tallyhouse.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near duplicates: words of a shingle, and similarity of 100.
SHINGLE, SIMILAR = 5, 80


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def with_own_names(stage: Stage) -> Stage:
    """Let columns beyond those of a document pass a stage under names that no operator uses."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        hidden = {name: f"_extra_{k}" for k, name in enumerate(docs.columns) if name not in DOCUMENT}
        out = stage(spark, docs.withColumnsRenamed(hidden), sf_dir)
        return out.withColumnsRenamed({own: name for name, own in hidden.items()})

    return run


@with_own_names
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality rules reject."""
    return quality.judged(docs, keep=tuple(docs.columns)).where("kept").select(*docs.columns)


@with_own_names
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated lines; a document of which no word is left goes. ``n_chars`` follows the text."""
    cut = linededup.deduplicate_lines(docs)
    nothing_left = (F.col("n_removed") > 0) & F.col("text").rlike(r"\A[\x20\x09-\x0D]*\z")
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    return cut.where(~nothing_left).select(*[length if c == "n_chars" else c for c in docs.columns])


@with_own_names
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest doc_id in each group of near duplicates.

    Rows that repeat a doc_id with another text are documents of their own, known by a 64-bit hash of both. Of rows
    that repeat both, the smallest by the other columns stays; rows without a doc_id all stay.
    """
    node = F.xxhash64("doc_id", "text")
    known = docs.where("doc_id is not null").withColumn("_node", node)
    found = neardup.near_duplicates(known.select(F.col("_node").alias("doc_id"), "text"), size=SHINGLE, percent=SIMILAR)
    component = found.select(F.col("doc_id").alias("_node"), "component_id").distinct()
    places = known.select("_node", "doc_id").distinct().join(component, "_node")
    first = places.groupBy("component_id").agg(F.min(F.struct("doc_id", "_node")).alias("first")).select("first._node")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    own = [F.to_json(F.struct(c)) if c not in DOCUMENT else F.col(c) for c in rest]
    rank = F.row_number().over(Window.partitionBy("_node").orderBy(*own, F.lit(0)))
    kept = known.join(first, "_node", "left_semi").withColumn("_rank", rank).where("_rank = 1")
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))


@with_own_names
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a benchmark window occurs."""
    found = decontam.find_items(docs, table(spark, sf_dir, "benchmark"), keep=tuple(docs.columns))
    return found.where("n_hit = 0").select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left, with digests of ids and decoded text."""
    return bpe.encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: Neither signatures nor byte-pair encoding can be told in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table; each stage's rows are stored before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
