"""Compare query results with SQL run by DuckDB on the same files."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _rows(table) -> Counter:
    """Rows as a bag; columns by name, so their order does not matter."""
    columns = sorted(table.column_names)
    lists = [table.column(c).to_pylist() for c in columns]
    return Counter(zip(*lists))


def _kinds(table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_string", "string") for f in table.schema}


def differences(spark_result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types, row count or values; empty when all agree."""
    left, right = spark_result.toArrow(), connection.sql(sql).to_arrow_table()
    found = []
    if _kinds(left) != _kinds(right):
        pairs = set(_kinds(left).items()) ^ set(_kinds(right).items())
        found.append(f"columns differ: {sorted(pairs)}")
    if sorted(left.column_names) != sorted(right.column_names):
        return found
    if left.num_rows != right.num_rows:
        found.append(f"rows: {left.num_rows} != {right.num_rows}")
    ours, theirs = _rows(left), _rows(right)
    if ours != theirs:
        extra, missing = list((ours - theirs).elements()), list((theirs - ours).elements())
        found.append(f"{len(extra)} rows only in Spark, e.g. {extra[:2]}; only in SQL: {missing[:2]}")
    return found
