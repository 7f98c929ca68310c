"""Column expressions that turn text into typed values.

Text that does not fit the type becomes NULL, and every expression stays inside
the JVM. Build DataFrames from these expressions under
``session.bad_casts_give_null``; ``cast_to_columns`` and the catalog scans do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and type names of the conversion.
DATE_FORMAT = "yyyy-MM-dd"
TIME_OF_DAY_FORMAT = "HH:mm:ss"
DATE_TYPES = ("date",)
TIMESTAMP_TYPES = ("timestamp", "timestamp with time zone")
INT_TYPES = ("int", "integer")
LONG_TYPES = ("bigint", "long")
DOUBLE_TYPES = ("double", "float", "decimal")
SMALL_TYPES = ("smallint", "short", "tinyint", "byte")
SMALL_BITS = {"smallint": 16, "short": 16, "tinyint": 8, "byte": 8}
PLAIN_TYPES = ("boolean", "binary", "string", "double")
#: All that a cast reads as a floating-point number: digits with a point, an exponent and a suffix,
#: or something that begins like infinity, a value that is no number, or a hexadecimal number.
FLOATING = (
    r"^[\x00-\x20]*+[+-]?(?:(?:[0-9]++\.?[0-9]*+|\.[0-9]++)(?:[eE][+-]?[0-9]++)?[fFdD]?[\x00-\x20]*+\z"
    r"|(?i:nan|inf|0x))"
)
TIME_OF_DAY = r"^(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z"


def text_to_whole_number(text: Column, type_name: str) -> Column:
    """Text to ``int`` or ``bigint``; a decimal fraction is cut off, not rounded.

    A plain cast, because ``try_cast`` has no value for ``12.7`` and raises
    inside for each misfit, which costs a hundred times a good value. The cast
    reads a lone point as 0: text without a digit is no number.
    """
    value = text.cast(type_name)
    return F.when((value == 0) & ~text.rlike("[0-9]"), None).otherwise(value)


def text_to_small_number(text: Column, type_name: str) -> Column:
    """Text to ``smallint`` or ``tinyint``; a value out of range is compared, not tried."""
    number = text_to_whole_number(text, "int")
    bound = 1 << (SMALL_BITS[type_name] - 1)
    return F.when(number.between(-bound, bound - 1), number.cast(type_name))


def text_to_floating(text: Column, type_name: str = "double") -> Column:
    """Text to ``double`` or ``float``.

    Either cast parses a misfit until an exception ends it, which takes four times as long
    as a good value; text that cannot be a number is not parsed.
    """
    return F.when(text.rlike(FLOATING), text.try_cast(type_name))


def text_to_date(text: Column, date_format: str = DATE_FORMAT) -> Column:
    """Text to date by a pattern, which the whole text must match.

    The default pattern is checked on the bytes, and a cast reads the value: the
    cast alone would also take ``2024-1-5``, and a pattern parser is four times
    slower for good values and far more so for bad ones.
    """
    if date_format != DATE_FORMAT:
        return F.try_to_date(text, date_format)
    # A year before 0 has a sign.
    body = F.when(F.startswith(text, F.lit("-")), F.substring(text, 2, 11)).otherwise(text)
    strict = (
        (F.octet_length(body) == 10)
        & (F.substring(body, 5, 1) == "-")
        & (F.substring(body, 8, 1) == "-")
        & F.substring(body, 10, 1).between("0", "9")
    )
    return F.when(strict, text.cast("date"))


def text_to_timestamp(text: Column, timestamp_format: str = TIME_OF_DAY_FORMAT) -> Column:
    """Text to timestamp. The default pattern is a time of day, on 1970-01-01.

    The default pattern is checked first, and a cast reads what has it: the pattern parser
    takes seven times as long for text that does not fit.
    """
    if timestamp_format == TIME_OF_DAY_FORMAT:
        day_and_time = F.concat(F.lit("1970-01-01 "), text)
        return F.when(text.rlike(TIME_OF_DAY), day_and_time.cast("timestamp"))
    return F.try_to_timestamp(text, F.lit(timestamp_format))


def cast_column(
    column: Column,
    source_type: str,
    target_type: str,
    date_format: str = DATE_FORMAT,
    timestamp_format: str = TIME_OF_DAY_FORMAT,
) -> Column:
    """Expression for one column of type ``source_type`` under ``target_type``.

    Type names that the conversion does not know leave the column as it is.
    """
    source = source_type.strip().lower()
    target = target_type.strip().lower()
    if source == target:
        return column
    is_text = source == "string"
    if target in DATE_TYPES:
        return text_to_date(column, date_format) if is_text else column.try_cast("date")
    if target in TIMESTAMP_TYPES:
        if is_text:
            return text_to_timestamp(column, timestamp_format)
        return column if source == "timestamp" else column.try_cast("timestamp")
    if target in INT_TYPES:
        return text_to_whole_number(column, "int") if is_text else column.try_cast("int")
    if target in LONG_TYPES:
        return text_to_whole_number(column, "bigint") if is_text else column.try_cast("bigint")
    if target in DOUBLE_TYPES:
        return text_to_floating(column) if is_text else column.try_cast("double")
    if target.startswith("decimal("):
        return column.try_cast(target)
    return column


def cast_to_declared(
    column: Column,
    source_type: str,
    target_type: str,
    date_format: str = DATE_FORMAT,
    timestamp_format: str = TIME_OF_DAY_FORMAT,
) -> Column:
    """Expression of exactly the type a catalog table declares, so that it can be read.

    Types that no cast of one value reaches (arrays, maps, structures) are an error.
    """
    source = source_type.strip().lower()
    target = target_type.strip().lower()
    text_alike = target.startswith(("char(", "varchar("))
    if source == target or (text_alike and source == "string"):
        return column
    is_text = source == "string"
    if target in SMALL_TYPES and is_text:
        return text_to_small_number(column, target)
    if target == "float":
        return cast_column(column, source, "double").cast("float")
    if target == "boolean" and is_text:
        # ``try_cast`` raises inside for each misfit, as with whole numbers.
        return column.cast("boolean")
    if target == "timestamp_ntz" and is_text:
        return text_to_timestamp(column, timestamp_format).cast("timestamp_ntz")
    known = DATE_TYPES + TIMESTAMP_TYPES + INT_TYPES + LONG_TYPES + DOUBLE_TYPES
    if target in known or target.startswith("decimal("):
        return cast_column(column, source, target, date_format, timestamp_format)
    if target in SMALL_TYPES + PLAIN_TYPES + ("timestamp_ntz",):
        return column.try_cast(target)
    if text_alike:
        return column.cast("string")
    raise ValueError(f"no cast from {source_type} to {target_type}")


def read_declared(text: Column, declared_type: str) -> Column:
    """Text of a raw table under the type its catalog entry declares."""
    declared = declared_type.strip().lower()
    if declared == "string" or declared.startswith(("char(", "varchar(")):
        return text
    if declared in INT_TYPES + LONG_TYPES:
        return text_to_whole_number(text, "int" if declared in INT_TYPES else "bigint")
    if declared in ("double", "float"):
        return text_to_floating(text, declared)
    return text.cast(declared)
