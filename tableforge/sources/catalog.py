"""Catalog databases and tables: declare, list, look up.

Look-ups read catalog metadata only. ``spark.table(name).schema`` would list
every file of the table first, which is slow for a large location.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tableforge.names import Columns, column_list, columns_of, literal, quoted, quoted_path
from tableforge.sources.text import RAW_TABLE_FORMAT, TextFormat

# Types that stay text in a raw table.
TYPES_KEPT_AS_TEXT = ("date", "timestamp")
#: Partitions that one statement registers.
PARTITIONS_AT_ONCE = 200


@dataclass(frozen=True)
class TableDescription:
    name: str
    columns: tuple[tuple[str, str], ...]
    partition_columns: tuple[str, ...]
    provider: str
    location: str | None
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def is_text(self) -> bool:
        """CSV data source table, or a Hive table over delimited text."""
        return self.provider == "csv" or (self.provider == "hive" and "field.delim" in self.options)

    @property
    def text_format(self) -> TextFormat:
        return TextFormat.from_table_options(self.options)


def raw_columns(typed: str | StructType | Columns) -> list[tuple[str, str]]:
    """Columns of the raw text table that belongs to a typed table.

    Text files carry dates and times as text; every other type is declared alike.
    """
    return [
        (name, "string" if type_name in TYPES_KEPT_AS_TEXT else type_name)
        for name, type_name in columns_of(typed)
    ]


def list_datasets(spark: SparkSession, database: str) -> list[str]:
    """Names of the tables of a database, by name. Views have no files and are no datasets."""
    return sorted(
        t.name
        for t in spark.catalog.listTables(database)
        if not t.isTemporary and t.tableType != "VIEW"
    )


def describe_table(spark: SparkSession, table: str) -> TableDescription | None:
    """Catalog entry of ``database.table``; None only if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    name = quoted_path(table)
    entry = json.loads(
        spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()["json_metadata"]
    )
    rows = spark.sql(f"DESCRIBE TABLE {name}").select("col_name", "data_type").collect()
    return TableDescription(
        name=table,
        # Partition columns come again in a section of their own.
        columns=tuple(map(tuple, rows[: len(entry["columns"])])),
        partition_columns=tuple(entry.get("partition_columns", ())),
        provider=entry.get("provider", "").lower(),
        location=entry.get("location"),
        options=entry.get("storage_properties", {}),
    )


def declare_text_table(
    spark: SparkSession,
    table: str,
    schema: str | StructType | Columns,
    location: str,
    text_format: TextFormat = RAW_TABLE_FORMAT,
) -> None:
    """External table over delimited text, unless the table exists."""
    options = ", ".join(
        f"{literal(key)} {literal(value)}" for key, value in text_format.options().items()
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted_path(table)} ({column_list(schema)}) "
        f"USING csv OPTIONS ({options}) LOCATION {literal(location)} "
        "TBLPROPERTIES ('classification' = 'csv')"
    )


def declare_parquet_table(
    spark: SparkSession,
    table: str,
    schema: str | StructType | Columns,
    location: str,
    partition_by: Sequence[str] = (),
) -> None:
    """External table over Parquet, unless the table exists.

    Partitions become visible with a conversion into the table, or with
    ``spark.catalog.recoverPartitions`` where the files are there already.
    """
    partitions = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))}) " if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted_path(table)} ({column_list(schema)}) "
        f"USING parquet {partitions}LOCATION {literal(location)}"
    )


def declare_database(
    spark: SparkSession,
    kind: str,
    database: str,
    schemas: Mapping[str, str | StructType | Columns],
    base_path: str,
    text_format: TextFormat = RAW_TABLE_FORMAT,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> list[str]:
    """Declare one table per schema, each over ``base_path/<table>``.

    ``schemas`` holds the typed columns. ``kind`` is "raw" for delimited text or
    "typed" for Parquet; the raw columns follow from the typed ones.
    """
    if kind not in ("raw", "typed"):
        raise ValueError(f"kind must be 'raw' or 'typed', not {kind!r}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    for name, schema in schemas.items():
        table, location = f"{database}.{name}", f"{base_path.rstrip('/')}/{name}"
        if kind == "raw":
            declare_text_table(spark, table, raw_columns(schema), location, text_format)
        else:
            keys = (partition_by or {}).get(name, ())
            declare_parquet_table(spark, table, schema, location, keys)
    return list(schemas)


def drop_table(spark: SparkSession, table: str) -> None:
    """Remove the catalog entry; the files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted_path(table)}")


def add_partitions(
    spark: SparkSession, table: TableDescription, partitions: Iterable[Sequence[str | None]]
) -> None:
    """Register ``partitions`` (values as text, in the order of the keys), those that are new.

    Nothing is listed, however many partitions the table has.
    """
    found = list(dict.fromkeys(tuple(value or None for value in values) for values in partitions))
    keys = list(map(quoted, table.partition_columns))
    for at in range(0, len(found), PARTITIONS_AT_ONCE):
        specs = []
        for values in found[at : at + PARTITIONS_AT_ONCE]:
            shown = ["NULL" if value is None else literal(value) for value in values]
            specs.append(f"PARTITION ({', '.join(f'{k} = {v}' for k, v in zip(keys, shown, strict=True))})")
        spark.sql(f"ALTER TABLE {quoted_path(table.name)} ADD IF NOT EXISTS {' '.join(specs)}")


@contextmanager
def use_database(spark: SparkSession, database: str | None) -> Iterator[None]:
    """Make ``database`` the default for unqualified names, then go back."""
    if database is None:
        yield
        return
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)
