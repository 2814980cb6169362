"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import alignment, bpe, convrepair, decontam, langid, linededup, neardup, pylm, quality, simhash, sql, tokenfile, urlfilter, warc
from tallyhouse.llm.common import table



def remainder(column: str, divisor: int) -> Column:
    """crc32 of a number's decimal text, modulo ``divisor``; a null counts as 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0)) % divisor


Query = Callable[[SparkSession, str], DataFrame]


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(table(spark, folder, "documents"), with_ids=False)


def op2_minhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), size=4, percent=80)


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"))


def op6_packed_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfile.token_files(table(spark, folder, "documents"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = linededup.deduplicate_lines(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", "text")


def op8_pitman_yor_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = remainder("doc_id", 5) == 1
    scores = pylm.language_model_scores(documents, ~held_out)
    return scores.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        pylm.perplexity(F.col("score"), F.col("n_tokens")).alias("perplexity"),
    )


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = remainder("doc_id", 4) == 2
    classifier = langid.trained(documents, ~held_out)
    return langid.predicted(documents, classifier).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, folder, "documents"))


def op12_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_near_duplicates(table(spark, folder, "documents"), size=4, radius=4)


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return convrepair.damaged_and_repaired(table(spark, folder, "conversations"))


QUERIES: tuple[Query, ...] = (
    op1_byte_bpe,
    op2_minhash_near_duplicates,
    op3_benchmark_decontamination,
    op4_warc_archives,
    op5_quality_rules,
    op6_packed_token_files,
    op7_line_dedup,
    op8_pitman_yor_scores,
    op9_language_id,
    op10_url_filters,
    op11_tokenizer_alignment,
    op12_simhash_near_duplicates,
    op13_conversation_repair,
)


def llm_queries() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES}


def llm_oracle() -> dict[str, str]:
    """SQL for the queries that it can express; the others are tested against plain versions."""
    return {
        "op2_minhash_near_duplicates": sql.NEAR_DUPLICATES,
        "op3_benchmark_decontamination": sql.DECONTAMINATION,
        "op4_warc_archives": sql.ARCHIVES,
        "op5_quality_rules": sql.quality_rules(),
        "op7_line_dedup": sql.LINE_DEDUP,
        "op10_url_filters": sql.url_filters(),
        "op13_conversation_repair": sql.conversation_repair(),
    }
