"""Quality rules whose thresholds follow the corpus.

One pass counts words, symbols and repetitions in each text. The ratios of
all texts go into quantile sketches, one for each language and source: counts by
logarithmic bucket, which bound the relative error of a quantile and merge by addition. Sketches of
small groups are merged upwards, to the language and then to the whole
corpus. A text fails where a ratio lies beyond its group's outer fence: three
interquartile ranges past the quartile. The thresholds are joined to the texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyhouse.llm.common import Columns, map_columns, stored, text_bytes

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Relative error of a quantile.
ERROR = 0.01
#: A group of fewer texts uses the thresholds of the next larger one.
MIN_GROUP = 200
FENCE = 3.0
#: Ratios, with the smallest interquartile range that their fence assumes and whether low values count too.
RATIOS = {
    "symbols_per_word": (0.05, False),
    "duplicate_line_share": (0.2, False),
    "word_length": (1.5, True),
}

COUNTS = T.StructType(
    [T.StructField(n, T.LongType(), False) for n in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")]
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter(map(number.setdefault, words, count()), dtype=np.int64, count=len(words))
    runs = len(words) - window + 1
    keys = ids[:runs]
    for k in range(1, window):
        # Numbers of the longer runs stay below the count of words, so nothing overflows.
        keys = keys * len(words) + ids[k : k + runs]
        if k + 1 < window:
            keys = np.unique(keys, return_inverse=True)[1]
    _, group, size = np.unique(keys, return_inverse=True, return_counts=True)
    again = size[group] > 1
    if not again.any():
        return 0
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[:runs] += again
    edges[window : window + runs] -= again
    return int((np.cumsum(edges[:-1]) > 0).sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = text_bytes(text).split()
    lines = [line for line in text_bytes(text).split(b"\n") if line.split()]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        sum(n - 1 for n in Counter(lines).values()),
        repeated_words(words),
    )


def measured(documents: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The ``keep`` columns with the counts of each row's text."""
    schema = T.StructType([documents.schema[c] for c in keep] + COUNTS.fields)

    def counted(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            rows = list(map(counts_of, batch["text"]))
            yield {name: batch[name] for name in keep} | {
                name: [row[k] for row in rows] for k, name in enumerate(COUNTS.names)
            }

    return map_columns(documents.select(*dict.fromkeys([*keep, "text"])), schema, counted)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def ratios() -> dict[str, Column]:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "duplicate_line_share": F.col("n_dup_lines") / lines,
        "word_length": F.col("word_chars") / words,
    }


def bucket(value: Column, error: float = ERROR) -> Column:
    """Logarithmic bucket of a ratio; null for zero, which has a bucket of its own."""
    return F.when(value > 0, F.ceil(F.log(value) / math.log((1 + error) / (1 - error))).cast("int"))


def bucket_value(number: Column, error: float = ERROR) -> Column:
    """The middle of a bucket."""
    gamma = (1 + error) / (1 - error)
    return F.coalesce(F.pow(F.lit(gamma), number) * (2 / (1 + gamma)), F.lit(0.0))


def sketches(counts: DataFrame) -> DataFrame:
    """``lang, source, ratio, bucket, n``: how many texts of a group lie in each bucket."""
    each = F.array(*[F.struct(F.lit(name).alias("ratio"), bucket(value).alias("bucket")) for name, value in ratios().items()])
    long = counts.where(~base_failed()).select("lang", "source", F.explode(each).alias("r"))
    return long.groupBy("lang", "source", "r.ratio", "r.bucket").agg(F.count("*").alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles of each ratio as columns of one row for each group, from bucket counts merged over the group."""
    merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "ratio")
    below = F.sum("n").over(group.orderBy(F.asc_nulls_first("bucket")).rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.withColumn("below", below).withColumn("all", F.sum("n").over(group))
    found = []
    for name in RATIOS:
        for label, q in (("q1", 0.25), ("q3", 0.75)):
            reached = (F.col("ratio") == name) & (F.col("below") >= F.ceil(F.col("all") * q))
            # The lowest bucket that reaches the rank; zero's bucket is the lowest of all.
            lowest = F.min(F.when(reached, F.struct(F.coalesce("bucket", F.lit(-(1 << 31))).alias("at"), "bucket")))
            found.append(bucket_value(lowest["bucket"]).alias(f"{name}_{label}"))
    return ranked.groupBy(*keys).agg(F.max("all").alias("texts"), *found)


def thresholds(sketch: DataFrame) -> DataFrame:
    """Lowest and highest ratio that each language and source allows.

    A group with too few texts takes the values of its language, a language with
    too few those of the corpus.
    """
    names = [f"{name}_{q}" for name in RATIOS for q in ("q1", "q3")]

    def level(keys: list[str], label: str) -> DataFrame:
        rows = quartiles(sketch, keys)
        return rows.select(*keys, F.col("texts").alias(f"{label}_texts"), *[F.col(n).alias(f"{label}_{n}") for n in names])

    languages, corpus = level(["lang"], "lang").withColumnRenamed("lang", "of"), level([], "all")
    joined = level(["lang", "source"], "own").join(languages, F.col("lang").eqNullSafe(F.col("of"))).join(F.broadcast(corpus))
    out = []
    for name, (least, both) in RATIOS.items():
        q1, q3 = (
            F.when(F.col("own_texts") >= MIN_GROUP, F.col(f"own_{name}_{q}"))
            .when(F.col("lang_texts") >= MIN_GROUP, F.col(f"lang_{name}_{q}"))
            .otherwise(F.col(f"all_{name}_{q}"))
            for q in ("q1", "q3")
        )
        reach = FENCE * F.greatest(q3 - q1, F.lit(least))
        out.append((q3 + reach).alias(f"{name}_most"))
        out.append((q1 - reach if both else F.lit(0.0)).alias(f"{name}_least"))
    return joined.select("lang", "source", *out)


def judged(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts and verdict for each row of ``documents (text, lang, source, ...)``.

    Returns the ``keep`` columns, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails the base rule. Null languages and
    sources are groups like others. Texts that fail the base rule are no
    part of the sketches; a group with no other text has no thresholds and needs
    none. Repeated rows get equal verdicts, an empty table an empty result. Texts are
    counted whole; columns beyond those named are ignored.
    """
    groups = ("lang", "source")
    columns = tuple(dict.fromkeys([*keep, *groups]))
    counts = stored(measured(documents, columns), "quality-counts")
    limits = stored(thresholds(sketches(counts)), "quality-thresholds").withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    met = F.lit(True)
    for name, value in ratios().items():
        met = met & value.between(F.col(f"{name}_least"), F.col(f"{name}_most"))
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    verdict = F.when(base_failed(), False).otherwise(F.coalesce(met, F.lit(True)))
    return counts.join(limits, same, "left").select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        verdict.alias("kept"),
    )
