"""Datasets: a catalog table read from a folder, or plain text."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.functions.casts import read_declared
from tableforge.names import column, column_list
from tableforge.session import bad_casts_give_null
from tableforge.sources.catalog import TableDescription, describe_table
from tableforge.sources.text import (
    EXTRA_VALUES,
    TEXT_THERE,
    UNEVEN_LINE,
    TextFormat,
    scan_text,
    scan_text_by_position,
    values_beyond,
)

logger = logging.getLogger(__name__)


#: What to do with values beyond the columns: not look, fail, or keep them.
EXTRA_VALUES_RULES = ("ignore", "error", "keep")
TOO_MANY_VALUES = "row with more values than columns"


class ExtraValues(ValueError):
    """Rows of text have values beyond the columns; ``rows`` is their number."""

    def __init__(self, dataset: str, rows: int | None = None):
        many = "some" if rows is None else str(rows)
        super().__init__(f"{dataset}: {many} rows have values beyond the columns")
        self.rows = rows


def with_extra_values(text: DataFrame, text_format: TextFormat, rule: str) -> DataFrame:
    """``text`` of an uneven scan after ``rule``, without the helper column.

    An error stops the job that reads the text, so nothing of it is written.
    """
    if rule not in EXTRA_VALUES_RULES:
        raise ValueError(f"extra values: one of {', '.join(EXTRA_VALUES_RULES)}, not {rule!r}")
    if UNEVEN_LINE not in text.columns:
        return text
    line = column(UNEVEN_LINE)
    beyond = values_beyond(line, len(text.columns) - 1, text_format)
    if rule == "keep":
        extra = F.when(line.isNotNull() & (F.size(beyond) > 0), beyond)
        return text.withColumn(EXTRA_VALUES, extra).drop(UNEVEN_LINE)
    fine = line.isNull() | (F.size(beyond) == 0)
    stop = F.raise_error(F.lit(TOO_MANY_VALUES)).cast("boolean")
    return text.where(F.when(fine, True).otherwise(stop)).drop(UNEVEN_LINE)


def with_text_there(rows: DataFrame) -> DataFrame:
    """``rows`` with a last column that says, column by column, where they have a value."""
    there = [column(name).isNotNull() for name in rows.columns if name != EXTRA_VALUES]
    return rows.withColumn(TEXT_THERE, F.array(*there))


def lost_values(names: Sequence[str]) -> list[Column]:
    """Aggregates of typed rows: how many values of each column the casts have lost."""
    there = column(TEXT_THERE)
    return [
        F.count(F.when(there[k] & column(name).isNull(), True)).alias(f"lost{k}")
        for k, name in enumerate(names)
    ]


def scan_catalog_table(
    spark: SparkSession,
    table: str | TableDescription,
    path: str | Sequence[str] | None = None,
    extra_values: str = "ignore",
    text_there: bool = False,
) -> DataFrame:
    """Rows of a catalog table under its declared types, read from ``path`` (or paths) where given.

    With ``text_there`` a last column tells where the text had a value, whatever its type made of it.
    """
    entry = describe_table(spark, table) if isinstance(table, str) else table
    if entry is None:
        raise ValueError(f"no such table: {table}")
    location = path or entry.location
    if not entry.is_text:
        reader = spark.read.format(entry.provider).schema(column_list(entry.columns))
        found = reader.option("recursiveFileLookup", True).load(location)
        return with_text_there(found) if text_there else found
    names = [name for name, _ in entry.columns]
    text = scan_text(spark, location, entry.text_format, names, extra_values != "ignore")
    text = with_extra_values(text, entry.text_format, extra_values)
    return declared_types(with_text_there(text) if text_there else text, entry)


def declared_types(text: DataFrame, entry: TableDescription) -> DataFrame:
    """Text columns of a raw table under the types the table declares."""
    casts = [read_declared(column(name), t).alias(name) for name, t in entry.columns]
    for name in (EXTRA_VALUES, TEXT_THERE):
        if name in text.columns and name not in dict(entry.columns):
            casts.append(column(name))
    with bad_casts_give_null(text.sparkSession):
        return text.select(*casts)


def scan_dataset(
    spark: SparkSession,
    dataset: str,
    path: str,
    source_db: str | None = None,
    text_format: TextFormat = TextFormat(),
    names: Sequence[str] | None = None,
    extra_values: str = "ignore",
    text_there: bool = False,
) -> DataFrame:
    """The dataset's catalog table read from ``path``, or plain text without one.

    ``text_format`` applies to plain text, and ``names`` to plain text without a
    header. Errors other than a missing table are not hidden.
    """
    if source_db is not None:
        entry = describe_table(spark, f"{source_db}.{dataset}")
        if entry is not None:
            return scan_catalog_table(spark, entry, path, extra_values, text_there)
        logger.warning("No table %s.%s, reading %s as plain text", source_db, dataset, path)
    uneven = extra_values != "ignore"
    if names is not None and not text_format.header:
        text = scan_text_by_position(spark, path, names, text_format, uneven)
    else:
        text = scan_text(spark, path, text_format, uneven=uneven)
    rows = with_extra_values(text, text_format, extra_values)
    return with_text_there(rows) if text_there else rows
