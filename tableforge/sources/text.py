"""Delimited text scans.

Every column is read as text, by position, and typed by an expression
afterwards. A value that does not fit then becomes NULL by one rule, whether it
is read under a raw table's type or cast to a target type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class TextFormat:
    """How rows are written in text files. An empty ``quote`` turns quoting off.

    With ``multi_line`` quoted values may hold line breaks. Such files are read by one task each, unless
    ``split_records`` says that they are well formed, see ``sources.records``.
    """

    sep: str = ","
    quote: str = '"'
    escape: str = "\\"
    header: bool = False
    null_value: str | None = None
    multi_line: bool = False
    split_records: bool = False

    def options(self) -> dict[str, str]:
        options = {
            "sep": self.sep,
            "quote": self.quote,
            "escape": self.escape,
            "header": str(self.header).lower(),
        }
        if self.multi_line:
            options["multiLine"] = "true"
        if self.split_records:
            options["splitRecords"] = "true"
        if self.null_value is not None:
            options["nullValue"] = self.null_value
        return options

    @classmethod
    def from_table_options(cls, options: Mapping[str, str]) -> TextFormat:
        """Format of a raw table: what it declares, a plain delimiter otherwise."""
        given = {key.lower(): value for key, value in options.items()}
        sep = given.get("sep") or given.get("delimiter") or given.get("field.delim")
        return cls(
            sep=sep or RAW_TABLE_FORMAT.sep,
            quote=given.get("quote", RAW_TABLE_FORMAT.quote),
            escape=given.get("escape") or RAW_TABLE_FORMAT.escape,
            header=given.get("header", "false").lower() == "true",
            null_value=given.get("nullvalue") or given.get("serialization.null.format"),
            multi_line=given.get("multiline", "false").lower() == "true",
            split_records=given.get("splitrecords", "false").lower() == "true",
        )


# Raw tables declare a delimiter and no quoting rule.
RAW_TABLE_FORMAT = TextFormat(sep="|", quote="")


def text_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


#: Column with the line of each row that has more or fewer values than there are columns.
UNEVEN_LINE = "__uneven_line"
#: Name of the column for values beyond the others, where they are kept.
EXTRA_VALUES = "extra_values"
#: Column that says which columns of the scan have text (or any value), in their order.
TEXT_THERE = "__text_there"


def _one_of(*chars: str) -> str:
    """Pattern of one character of ``chars``, whatever they mean in a pattern."""
    return "".join(f"\\x{{{ord(char):x}}}" for char in chars)


def value_pattern(text_format: TextFormat) -> str:
    """Pattern of a separator and the value after it, by the rules of the reader.

    A quote opens a value only at its start. There the escape takes the next character with
    it; after a closing quote the value goes on to the next separator. Every loop keeps
    what it has taken, so a line is read once, however long it is.
    """
    sep = "".join(_one_of(char) for char in text_format.sep)
    plain = f"[^{sep}]*+" if len(text_format.sep) == 1 else f"(?:(?!{sep}).)*+"
    quote, escape = _one_of(*text_format.quote), _one_of(*text_format.escape)
    if not quote:
        return f"(?s){sep}({plain})"
    inside = f"[^{quote}{escape}]*+"
    if text_format.escape == text_format.quote:
        inside += f"(?:{quote}{quote}{inside})*+"
    elif escape:
        inside += f"(?:{escape}.{inside})*+"
    return f"(?s){sep}({quote}{inside}{quote}{plain}|{plain})"


def values_beyond(line: Column, width: int, text_format: TextFormat) -> Column:
    """Array of the values of ``line`` after the first ``width``, without quotes.

    Empty values count for nothing, as at a delimiter that ends the line. A line with
    fewer delimiters than columns has none and is not taken apart.
    """
    sep, quote = F.lit(text_format.sep), text_format.quote
    values = F.regexp_extract_all(F.concat(sep, line), F.lit(value_pattern(text_format)), 1)
    beyond = F.slice(values, width + 1, F.greatest(F.size(values) - width, F.lit(0)))
    if quote:
        beyond = F.transform(
            beyond,
            lambda value: F.when(
                value.startswith(quote) & value.endswith(quote) & (F.length(value) > 1),
                F.substring(value, F.lit(2), F.length(value) - 2),
            ).otherwise(value),
        )
    beyond = F.filter(beyond, lambda value: F.length(F.btrim(value)) > 0)
    marks = F.length(line) - F.length(F.replace(line, sep, F.lit("")))
    few = marks < F.lit(width * len(text_format.sep))
    return F.when(few, F.array().cast("array<string>")).otherwise(beyond)


def scan_text(
    spark: SparkSession,
    path: str | Sequence[str],
    text_format: TextFormat = TextFormat(),
    names: Sequence[str] | None = None,
    uneven: bool = False,
) -> DataFrame:
    """All text files below ``path``, every column a string, named ``names``.

    Without ``names`` the columns are named by the header, or ``_c0``, ``_c1``, …
    A file whose header differs from the first one's is an error; it is not read into
    the wrong columns. Only a header with equal names is not compared, as Spark numbers
    these. With ``uneven`` a last column has the whole line of each row whose number of
    values differs from the number of columns; such a scan reads all columns.
    """
    reader = spark.read.options(**text_format.options()).option("recursiveFileLookup", True)
    path = path if isinstance(path, str) else list(path)
    check_header = False
    if names is None:
        found = reader.csv(path)
        split = text_format.multi_line and text_format.split_records
        check_header = text_format.header and not _has_equal_names(spark, path, text_format)
        if check_header:
            reader = reader.option("enforceSchema", False)
        elif not uneven and not split:
            return found
        names = found.columns
    if text_format.multi_line and text_format.split_records and text_format.quote:
        from tableforge.sources.records import scan_split_records

        return scan_split_records(spark, path, text_format, names, uneven, check_header)
    schema = text_schema(names)
    if uneven:
        schema = schema.add(UNEVEN_LINE, StringType())
        reader = reader.option("columnNameOfCorruptRecord", UNEVEN_LINE)
    return reader.schema(schema).csv(path)


def _has_equal_names(spark: SparkSession, path: str, text_format: TextFormat) -> bool:
    options = {**text_format.options(), "header": "false"}
    first = spark.read.options(**options).option("recursiveFileLookup", True).csv(path).first()
    names = [name.lower() for name in first or () if name is not None]
    return len(set(names)) < len(names)


def scan_text_by_position(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    text_format: TextFormat,
    uneven: bool = False,
) -> DataFrame:
    """Text without a header under ``names``; values beyond them stay as ``_cN``."""
    found = scan_text(spark, path, text_format).columns
    return scan_text(spark, path, text_format, [*names, *found[len(names) :]], uneven)
