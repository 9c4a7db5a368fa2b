"""Compare a Spark result with the rows of its SQL in another engine, value by value."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types of column or rows; empty when equal. Row order is ignored."""
    answer = connection.execute(sql)
    names = [column[0] for column in answer.description]
    types = {column[0]: str(column[1]) for column in answer.description}
    found = []
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} against {sorted(names)}"]
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    for name, kind in result.dtypes:
        if kinds[kind] != types[name]:
            found.append(f"type of {name}: {kind} against {types[name]}")
    order = sorted(names)
    places = [names.index(name) for name in order]
    theirs = Counter(tuple(row[i] for i in places) for row in answer.fetchall())
    ours = Counter(tuple(row[name] for name in order) for row in result.collect())
    if ours != theirs:
        found.append(
            f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only here {list((ours - theirs).items())[:2]}, "
            f"only there {list((theirs - ours).items())[:2]}"
        )
    if not theirs:
        found.append("no rows to compare")
    return found
