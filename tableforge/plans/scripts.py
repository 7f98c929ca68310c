"""Corpora of SQL scripts as a table of statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.functions.script_text import statements
from tableforge.names import column


def read_scripts(
    spark: SparkSession, path: str, glob: str | None = None, separator: str | None = None
) -> DataFrame:
    """One row ``(script_id, script)`` per file below ``path``; the id is the file's path.

    With ``separator`` a file holds many scripts, one after the other with that text in
    between; a large corpus then needs no file for each script, and files can be split.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if separator is not None:
        found = reader.text(path, lineSep=separator)
    else:
        found = reader.text(path, wholetext=True)
    return found.select(
        F.col("_metadata.file_path").alias("script_id"), F.col("value").alias("script")
    )


def statement_table(
    scripts: DataFrame,
    id_column: str = "script_id",
    text_column: str = "script",
    partitions: int | None = None,
    quotes: bool = False,
) -> DataFrame:
    """One row ``(script_id, statement_no, statement)`` per statement, numbered from 1.

    A script is taken apart where it is read; nothing is shuffled. Only for few large
    files, read by fewer tasks than there are cores, give ``partitions`` to deal the
    scripts out first. With ``quotes`` separators and comment marks between quotes are text.
    """
    if partitions is not None:
        scripts = scripts.repartition(partitions)
    return scripts.select(
        column(id_column).alias("script_id"), F.posexplode(statements(column(text_column), quotes))
    ).select(
        "script_id",
        (F.col("pos") + 1).alias("statement_no"),
        F.col("col").alias("statement"),
    )
