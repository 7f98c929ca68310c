"""Delimited text whose quoted values hold line breaks, read in splits.

Spark's reader takes such a file in one task, as it cannot know whether a split begins between
quotes. Here lines are read in splits, and what a line lacks is found by sums:

1. a line turns "outside" to "inside" of quotes, or back, if it has an odd number of quotes
   that are not escaped; the odd lines of each block of a file are counted;
2. sums over the blocks of a file, in their order, tell where each block begins inside quotes;
3. sums over the lines of a block tell the same of each line; a line that begins outside begins a
   record, and runs of lines are gathered to records;
4. only what a block's border cuts, the first and the last run of a block, is put together over
   the blocks of its file.

Each record is then parsed by Spark's own parser. The text is shuffled once, by block, so a task
holds at most a block and a record, however large the file is. A block whose begin the first
pass did not see (another number of cores may cut files elsewhere) is an error, not a guess.

The files must be well formed: quotes stand only in quoted values, and there they are escaped. Lines
end in ``\\n`` or ``\\r\\n``. Empty lines outside of quotes are no records, as for the reader. A value
that is never closed goes on to the end of its file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tableforge.names import column_list
from tableforge.sources.text import UNEVEN_LINE, TextFormat, text_schema

BLOCK = ("file", "block")


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, block, pos, line``; ``pos`` grows with the lines of a block."""
    paths = path if isinstance(path, str) else list(path)
    found = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(paths)
    return found.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def turns(line: Column, text_format: TextFormat) -> Column:
    """1 if the line has an odd number of quotes that are not escaped, else 0."""
    quote, escape = text_format.quote, text_format.escape
    if escape and escape != quote:
        # The escape takes the next character with it, whatever that is.
        line = F.regexp_replace(line, rf"(?s)\x{{{ord(escape):x}}}.", "")
    return (F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))) % 2


def records(lines: DataFrame, text_format: TextFormat) -> DataFrame:
    """``file, block, record, text`` of each record, named by where it begins; 1 is a block's first."""
    odd = lines.withColumn("turns", turns(F.col("line"), text_format))
    blocks = odd.groupBy(*BLOCK).agg(F.sum("turns").alias("turns"))
    above = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(*BLOCK, (F.coalesce(F.sum("turns").over(above), F.lit(0)) % 2).alias("start"))
    known = F.coalesce(F.col("start"), F.raise_error(F.lit("block not seen before: read again")).cast("bigint"))
    by_line = Window.partitionBy(*BLOCK).orderBy("pos")
    before = by_line.rowsBetween(Window.unboundedPreceding, -1)
    inside = (known + F.coalesce(F.sum("turns").over(before), F.lit(0))) % 2
    marked = odd.join(starts, list(BLOCK), "left").withColumn("inside", inside)
    to_here = by_line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = marked.withColumn("record", F.sum(1 - F.col("inside")).over(to_here))
    pieces = marked.groupBy(*BLOCK, "record").agg(
        F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("lines"),
        ((F.min_by("inside", "pos") + F.sum("turns")) % 2).alias("open"),
    )
    text = F.array_join(F.transform("lines", lambda line: line["line"]), "\n").alias("text")
    cut = (F.col("record") == 0) | (F.col("open") == 1)
    whole = pieces.where(~cut).select(*BLOCK, "record", text)
    return whole.union(_joined(pieces.where(cut).select(*BLOCK, "record", text)))


def _joined(pieces: DataFrame) -> DataFrame:
    """Records of the pieces that borders of blocks have cut; a piece numbered 0 goes on with one."""
    in_file = Window.partitionBy("file").orderBy(F.col("block"), F.col("record"))
    number = F.sum(F.when(F.col("record") > 0, 1).otherwise(0)).over(in_file)
    parts = F.sort_array(F.collect_list(F.struct("block", "record", "text")))
    found = pieces.withColumn("number", number).groupBy("file", "number").agg(parts.alias("parts"))
    first = F.col("parts")[0]
    return found.select(
        "file",
        first["block"].alias("block"),
        first["record"].alias("record"),
        F.array_join(F.transform("parts", lambda part: part["text"]), "\n").alias("text"),
    )


def scan_split_records(
    spark: SparkSession,
    path: str | Sequence[str],
    text_format: TextFormat,
    names: Sequence[str],
    uneven: bool = False,
    check_header: bool = False,
) -> DataFrame:
    """Rows of the text below ``path`` under ``names``, every column a string.

    ``uneven`` adds the text of rows whose number of values differs from that of ``names``. With
    ``check_header`` a file whose header has other names is an error.
    """
    found = records(numbered_lines(spark, path), text_format)
    text = F.when(F.endswith("text", F.lit("\r")), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    found = found.withColumn("text", text).where(F.btrim("text") != "")
    schema = text_schema(names)
    if uneven:
        schema = schema.add(UNEVEN_LINE, StringType())
    options = {key: value for key, value in text_format.options().items() if key not in ("header", "multiLine")}
    options["columnNameOfCorruptRecord"] = UNEVEN_LINE
    row = F.from_csv("text", column_list(schema), options)
    rows = found.select((F.col("block") + F.col("record") == 1).alias("is_first"), row.alias("row"))
    if text_format.header:
        keep = ~F.col("is_first")
        if check_header:
            values = F.array(*(F.lower(F.coalesce(F.col("row")[name], F.lit(""))) for name in names))
            same = values == F.array(*(F.lit(name.lower()) for name in names))
            # One expression: of two filters the other might go first and hide the header.
            wrong = F.raise_error(F.lit("a file has another header")).cast("boolean")
            keep = F.when(keep, True).when(same, False).otherwise(wrong)
        rows = rows.where(keep)
    return rows.select(*(F.col("row")[name].alias(name) for name in schema.names))
