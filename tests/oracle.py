"""Comparison of a registered query with its SQL counterpart in DuckDB."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as registry

# Spark types and the DuckDB types that hold the same values.
SAME_TYPE = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def differences(spark: SparkSession, name: str, sf_dir: str) -> list[str]:
    """What differs between the query and its SQL; empty if nothing does."""
    got = registry.queries()[name](spark, sf_dir)
    with duck(sf_dir) as connection:
        relation = connection.sql(registry.oracle_sql()[name])
        expected = dict(zip(relation.columns, map(str, relation.types)))
        columns = sorted(expected)
        if sorted(got.columns) != columns:
            return [f"columns {sorted(got.columns)}, expected {columns}"]
        found = {c: SAME_TYPE.get(t, t) for c, t in got.dtypes}
        if found != expected:
            return [f"types {found}, expected {expected}"]
        order = ", ".join(f'"{c}"' for c in columns)
        want = Counter(relation.project(order).fetchall())
    have = Counter(tuple(row) for row in got.select(*columns).collect())
    if have == want:
        return []
    return [
        f"{sum(have.values())} rows, expected {sum(want.values())}",
        f"only in Spark: {list((have - want).items())[:3]}",
        f"only in SQL: {list((want - have).items())[:3]}",
    ]
