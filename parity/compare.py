"""Compare every registered query with its SQL twin.

    python -m parity.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from parity.queries import callables
from parity.sql import oracle

TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def differences(spark, connection, folder: str, name: str) -> list[str]:
    """What differs between the Spark result and the SQL result of one query."""
    df = callables()[name](spark, folder)
    columns = sorted(df.columns)
    ours = Counter(tuple(row) for row in df.select(*columns).collect())
    text = oracle()[name]
    described = {row[0]: row[1] for row in connection.execute(f"describe {text}").fetchall()}
    found = []
    if sorted(described) != columns:
        return [f"columns {columns} != {sorted(described)}"]
    for field in df.schema.fields:
        expected = TYPES[field.dataType.simpleString()]
        if described[field.name] != expected:
            found.append(f"{field.name}: {expected} != {described[field.name]}")
    quoted = ", ".join(f'"{column}"' for column in columns)
    theirs = Counter(connection.execute(f"select {quoted} from ({text})").fetchall())
    if ours != theirs:
        found.append(
            f"{sum(ours.values())} rows / {sum(theirs.values())} rows; only Spark {list((ours - theirs))[:2]}; "
            f"only SQL {list((theirs - ours))[:2]}"
        )
    elif not ours:
        found.append("empty on both sides")
    return found


def main(folder: str = "/root/testdata/sf0.001", *names: str) -> int:
    from tallyhouse.session import start

    spark = start("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(folder)
    bad = 0
    for name in names or callables():
        began = time.time()
        try:
            found = differences(spark, connection, folder, name) if name in oracle() else ["no SQL"]
        except Exception as error:  # noqa: BLE001 - report and go on
            found = [f"{type(error).__name__}: {str(error)[:900]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.1f}s {'; '.join(found)}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
