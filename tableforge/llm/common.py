"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.workspace import new_folder

#: The white space that separates words and is stripped from lines.
BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: later jobs read it and need no lineage."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and all else as it is.

    ``lower`` does the same to a text of ASCII alone and is many times faster.
    """
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


#: Rows of a batch that are Python objects at a time.
SLICE = 500
_kept: dict[tuple, object] = {}


def give_back() -> None:
    """Returns freed memory to the system, where the C library keeps it (glibc does)."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def kept_by_worker(make: Callable, *key):
    """What ``make`` returns for ``key``; a Python worker keeps it for the tasks to come.

    Only the last is kept: a worker that goes on to another operator has its memory again.
    """
    if (make, key) not in _kept:
        _kept.clear()
        give_back()
        _kept[make, key] = make(*key)
    return _kept[make, key]


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def fresh_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, made longer until no column in ``taken`` has it (case aside)."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted = f"{wanted}_"
    return wanted


def word_count(text: Column) -> Column:
    """Number of words, the runs of other characters than ``BLANKS``; 0 for null."""
    body = F.btrim(whole_text(text), F.lit(BLANKS))
    words = F.size(F.split(body, r"[\x20\x09-\x0D]+", -1))
    return F.when(F.length(body) == 0, 0).otherwise(words).cast("long")
