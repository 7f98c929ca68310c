"""Names and literals for use in SQL and column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Columns = Sequence[tuple[str, str]]


def quoted(name: str) -> str:
    """One name part, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def quoted_path(name: str) -> str:
    """``database.table``; dots separate the parts."""
    return ".".join(map(quoted, name.split(".")))


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column(name: str) -> Column:
    return F.col(quoted(name))


def columns_of(schema: str | StructType | Columns) -> list[tuple[str, str]]:
    """``(name, type)`` pairs of a DDL string, a schema or such pairs."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if isinstance(schema, StructType):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return [(name, type_name) for name, type_name in schema]


def column_list(schema: str | StructType | Columns) -> str:
    """The columns as they stand in DDL."""
    return ", ".join(f"{quoted(name)} {type_name}" for name, type_name in columns_of(schema))
