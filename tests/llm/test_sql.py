"""Queries against their SQL twins, on the smallest tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from tallyhouse.llm.queries import llm_oracle, llm_queries
from tests.llm.helpers import SMALL

TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def connection():
    found = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "conversations"):
        found.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return found


@pytest.mark.parametrize("name", sorted(llm_oracle()))
def test_query_matches_sql(spark, connection, name):
    df = llm_queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    described = {row[0]: row[1] for row in connection.execute(f"describe {llm_oracle()[name]}").fetchall()}
    assert described == {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    theirs = Counter(connection.execute(f"select {', '.join(columns)} from ({llm_oracle()[name]})").fetchall())
    ours = Counter(tuple(row) for row in df.select(*columns).collect())
    assert sum(ours.values()) == sum(theirs.values())
    assert not (ours - theirs), (list((ours - theirs))[:2], list((theirs - ours))[:2])
