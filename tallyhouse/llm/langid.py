"""Language identification by sparse multinomial logistic regression.

Features are character n-grams, hashed and weighted by TF-IDF. Document
frequencies are counted over all texts to learn from. The regression is
trained by follow-the-regularised-leader with elastic-net penalties on a bounded
sample, ``SAMPLE`` texts of each language, and a temperature is fitted on a part
of the sample that training did not see. Prediction is one pass over all texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyhouse.llm.common import Columns, map_columns, stored

#: Hash buckets of features, and lengths of the n-grams.
BUCKETS = 1 << 16
LENGTHS = (1, 2, 3)
#: Texts of each language in the training sample: the bound of what one task holds.
SAMPLE = 1000
#: Parts of a language that are cut down to the sample's size by themselves.
PARTS = 64
#: Most languages that can be told apart; more are an error, not a cut.
LANGUAGES = 1000
#: One of so many sampled texts is kept for the temperature.
CALIBRATE = 5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
#: Characters whose n-grams are counted at a time.
PIECE = 1 << 18
UNKNOWN = "und"

LETTER = regex.compile(r"\p{L}")
#: Runs without letters become one space.
GAPS = re.compile(r"[\W\d_]+")


def has_letter(text: str | None) -> bool:
    return bool(text) and LETTER.search(text) is not None


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams, ascending, and how often each occurs."""
    points = np.frombuffer(f" {GAPS.sub(' ', text.lower()).strip()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    counts = np.zeros(BUCKETS, dtype=np.int64)
    longest = max(LENGTHS)
    for start in range(0, len(points), PIECE):
        piece = points[start : start + PIECE + longest - 1].astype(np.uint64)
        value = np.zeros(len(piece), dtype=np.uint64)
        for length in range(1, longest + 1):
            # Each start once: the overlap with the next piece only completes n-grams.
            here = min(PIECE, len(piece) - length + 1)
            if here <= 0:
                break
            value = (value[:here] + piece[length - 1 : length - 1 + here] + np.uint64(length)) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
            if length in LENGTHS:
                counts += np.bincount(((value * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.int64), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def weighted(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of unit length."""
    values = (1 + np.log(counts)) * idf[found]
    norm = np.sqrt((values * values).sum())
    return values / norm if norm else values


def softmax(scores: np.ndarray) -> np.ndarray:
    grown = np.exp(scores - scores.max())
    return grown / grown.sum()


class Leader:
    """Follow-the-regularised-leader for several classes."""

    def __init__(self, classes: int):
        self.z = np.zeros((classes, BUCKETS))
        self.n = np.zeros((classes, BUCKETS))

    def weights(self, found: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[:, found], self.n[:, found]
        shrunk = np.sign(z) * L1 - z
        return np.where(np.abs(z) > L1, shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, found: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(found)
        error = softmax(weights @ values)
        error[label] -= 1
        gradient = error[:, None] * values
        squared = gradient * gradient
        n = self.n[:, found]
        self.z[:, found] += gradient - (np.sqrt(n + squared) - np.sqrt(n)) / ALPHA * weights
        self.n[:, found] = n + squared


def temperature(scores: list[np.ndarray], labels: list[int]) -> float:
    """The temperature of the least log loss, by golden-section search; 1 without texts."""
    if not scores:
        return 1.0
    rows, right = np.array(scores), np.array(labels)

    def loss(log_t: float) -> float:
        scaled = rows / np.exp(log_t)
        top = scaled.max(axis=1, keepdims=True)
        return float((np.log(np.exp(scaled - top).sum(axis=1)) + top[:, 0] - scaled[np.arange(len(right)), right]).mean())

    low, high, ratio = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Classifier:
    languages: list[str]
    idf: np.ndarray
    used: np.ndarray  # buckets that have a weight in any class
    weights: np.ndarray
    temperature: float

    def __post_init__(self):
        self.place = np.full(BUCKETS, -1, dtype=np.int64)
        self.place[self.used] = np.arange(len(self.used))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its probability; ``und`` and 0 without a letter or a language."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        found, counts = gram_counts(text)
        values, place = weighted(found, counts, self.idf), self.place[found]
        there = place >= 0
        share = softmax((self.weights[:, place[there]] @ values[there]) / self.temperature)
        best = int(share.argmax())
        return self.languages[best], float(share[best])


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and how many texts there are. One row for each bucket comes back."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType(), False), T.StructField("n", T.LongType(), False)])

    def counted(batches: Iterator[Columns]) -> Iterator[Columns]:
        seen, total = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                if has_letter(text):
                    seen[gram_counts(text)[0]] += 1
                    total += 1
        found = np.flatnonzero(seen)
        yield {"bucket": [-1, *found.tolist()], "n": [total, *seen[found].tolist()]}

    rows = map_columns(texts.select("text"), schema, counted).groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    by_bucket = dict(tuple(row) for row in rows)
    total = by_bucket.pop(-1, 0)
    found = np.zeros(BUCKETS, dtype=np.int64)
    found[list(by_bucket)] = list(by_bucket.values())
    return found, total


def training_sample(texts: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` different texts of each language, those of the smallest hashes."""
    mark = F.xxhash64("lang", "text")
    marks = texts.select("lang", mark.alias("mark")).distinct()
    # First within parts of a language, so that few rows of each meet in one task.
    part = F.pmod(F.col("mark"), F.lit(PARTS))
    for keys in (["lang", part], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("mark"))
        marks = marks.withColumn("rank", rank).where(F.col("rank") <= bound).drop("rank")
    chosen = stored(marks, "language-sample")
    if chosen.select("lang").distinct().count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    picked = texts.select("lang", "text", mark.alias("mark")).join(F.broadcast(chosen), ["lang", "mark"])
    return picked.dropDuplicates(["lang", "mark"])


COUNTED = T.StructType(
    [T.StructField("mark", T.LongType()), T.StructField("lang", T.StringType())]
    + [T.StructField(n, T.BinaryType()) for n in ("found", "counts")]
)


def sample_counts(sample: DataFrame) -> DataFrame:
    """N-gram counts of each sampled text with a letter, at most ``BUCKETS`` of them however long it is."""

    def counted(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for mark, lang, text in zip(batch["mark"], batch["lang"], batch["text"]):
                if has_letter(text):
                    found, counts = gram_counts(text)
                    yield {"mark": [mark], "lang": [lang], "found": [found.astype("<u2").tobytes()], "counts": [counts.astype("<i8").tobytes()]}

    return map_columns(sample.select("mark", "lang", "text"), COUNTED, counted)


def trained(documents: DataFrame, learn: Column, sample: int = SAMPLE, seed: int = 1) -> Classifier:
    """Learn from the rows where ``learn`` holds and neither ``text`` nor ``lang`` is null."""
    texts = documents.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    frequencies, total = document_frequencies(texts)
    idf = np.log((1 + total) / (1 + frequencies)) + 1
    model_type = T.StructType(
        [
            T.StructField("languages", T.ArrayType(T.StringType())),
            T.StructField("used", T.BinaryType()),
            T.StructField("weights", T.BinaryType()),
            T.StructField("temperature", T.DoubleType()),
        ]
    )

    def fit(batches: Iterator[Columns]) -> Iterator[Columns]:
        rows = sorted((row for batch in batches for row in zip(*(batch[c] for c in COUNTED.names))), key=lambda row: row[:2])
        languages = sorted({row[1] for row in rows})
        examples = []
        for _, lang, found, counts in rows:
            found, counts = np.frombuffer(found, dtype="<u2").astype(np.int64), np.frombuffer(counts, dtype="<i8")
            examples.append((found, weighted(found, counts, idf), languages.index(lang)))
        held = examples[::CALIBRATE] if len(examples) >= 20 * max(1, len(languages)) else []
        kept = [e for k, e in enumerate(examples) if not held or k % CALIBRATE]
        leader, rng = Leader(len(languages)), np.random.default_rng(seed)
        for _ in range(EPOCHS):
            for k in rng.permutation(len(kept)):
                leader.learn(*kept[k])
        weights = leader.weights(slice(None))
        used = np.flatnonzero(weights.any(axis=0))
        degree = temperature([weights[:, found] @ values for found, values, _ in held], [label for _, _, label in held])
        yield {
            "languages": [languages],
            "used": [used.astype("<i8").tobytes()],
            "weights": [np.ascontiguousarray(weights[:, used], dtype="<f8").tobytes()],
            "temperature": [degree],
        }

    # The sample is bounded in texts and in what is left of each, so one task may hold it.
    model = map_columns(sample_counts(training_sample(texts, sample)).repartition(1), model_type, fit).collect()
    if not model:
        return Classifier([], idf, np.empty(0, dtype=np.int64), np.empty((0, 0)), 1.0)
    row = model[0]
    used = np.frombuffer(row.used, dtype="<i8")
    return Classifier(row.languages, idf, used, np.frombuffer(row.weights, dtype="<f8").reshape(len(row.languages), len(used)), row.temperature)


PREDICTION = T.StructType([T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)])


def predicted(documents: DataFrame, classifier: Classifier, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``lang_pred`` and ``score`` for each row's ``text``, beside the ``keep`` columns.

    A null text, or one without a letter, is ``und`` with score 0, as is every
    text if nothing was learned. Texts are read whole. Repeated rows get equal
    results, an empty table none; other columns are no part of a prediction.
    """
    shared = documents.sparkSession.sparkContext.broadcast(classifier)
    schema = T.StructType([documents.schema[c] for c in keep] + PREDICTION.fields)

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            found = list(map(shared.value.predict, batch["text"]))
            yield {name: batch[name] for name in keep} | {"lang_pred": [lang for lang, _ in found], "score": [score for _, score in found]}

    return map_columns(documents.select(*dict.fromkeys([*keep, "text"])), schema, run)
