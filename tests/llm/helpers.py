"""Small tables with odd rows, and whole small tables, for the tests of the training-data operators."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
TEXTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# Names that the operators use themselves, as columns of the input.
CLASHING = ("n", "id", "root", "a", "b", "tile", "n_words", "spans", "verdict", "key", "stretch", "block", "first", "mark", "at")


def documents(spark, rows):
    """Rows of ``(doc_id, text, ...)`` as a documents table."""
    full = [(*row, *(None,) * (5 - len(row))) for row in rows]
    return spark.createDataFrame(full, TEXTS)


def with_clashes(df, *names):
    return df.select("*", *[F.lit("clash").alias(name) for name in names or CLASHING if name not in df.columns])


def whole(name):
    return pq.read_table(f"{SMALL}/{name}.parquet").to_pylist()


def by(rows, key="doc_id"):
    found = {row[key]: row.asDict() for row in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture(scope="session")
def small():
    return whole
