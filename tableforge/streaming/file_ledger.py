"""Conversion of files that are new or have changed, by a ledger that is a table.

A run lists the folder once, as a DataFrame of path, length and time of change, and converts the
files whose three values the ledger, a Parquet table, does not have. So a file that is written anew
under its old name is found, and nothing is remembered of files but rows of the ledger.

Batches are bounded by bytes and by files. Each is put in place once: its files are noted, its
output is written whole beside the ledger, its row count is noted, and only then is the output
moved. A run that failed before that note forgets the batch, and the next one plans it from what
is there then; a run that failed after it only has the move repeated.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.names import Columns
from tableforge.operators.casting import cast_to_columns
from tableforge.operators.conversion import (
    ConversionOptions,
    find_target,
    keys_of_target,
    put_in_place,
)
from tableforge.operators.ledger import DONE, STAGED
from tableforge.sinks.parquet import require_keys, split_keys, write_counted
from tableforge.sources.catalog import describe_table
from tableforge.sources.datasets import TOO_MANY_VALUES, ExtraValues, scan_catalog_table
from tableforge.streaming.incremental import IncrementalRun

FILE = ("path", "length", "modified")
FILES_SCHEMA = "path string, length bigint, modified bigint, batch bigint"
STEPS_SCHEMA = "batch bigint, state string, rows_read bigint"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modified`` (in microseconds) of each file below a folder; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def exactly(path: str) -> str:
    """A path as a pattern that only it fits."""
    return "".join(f"\\{char}" if char in "[]{}*?,^\\" else char for char in path)


class FileLedger:
    """The files of each batch, and how far it is: two Parquet tables that only grow."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        nothing = spark.createDataFrame([], STEPS_SCHEMA)
        nothing.write.mode("append").parquet(f"{self.path}/steps")
        spark.createDataFrame([], FILES_SCHEMA).drop("batch").write.mode("append").parquet(f"{self.path}/files")
        steps = spark.read.schema(STEPS_SCHEMA).parquet(f"{self.path}/steps")
        batch = F.max(F.when(F.col("state") == DONE, F.col("batch")))
        self.done: int = steps.agg(F.coalesce(batch, F.lit(0))).first()[0]
        waiting = steps.where((F.col("batch") > self.done) & (F.col("state") == STAGED)).first()
        #: Batch, and its rows, whose output is whole but perhaps not in place.
        self.waiting: tuple[int, int] | None = (waiting.batch, waiting.rows_read) if waiting else None

    def known(self) -> DataFrame:
        """Files of the batches that are done."""
        files = self.spark.read.schema(FILES_SCHEMA).parquet(f"{self.path}/files")
        return files.where(F.col("batch") <= self.done).select(*FILE)

    def plan(self, batch: int, files: Sequence[tuple]) -> None:
        rows = self.spark.createDataFrame(files, ", ".join(FILES_SCHEMA.split(", ")[:3]))
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/files/batch={batch}")

    def note(self, batch: int, state: str, rows: int) -> None:
        row = self.spark.createDataFrame([(batch, state, rows)], STEPS_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/steps")
        self.done = batch if state == DONE else self.done

    def staged_path(self, batch: int) -> str:
        return f"{self.path}/staged/{batch}"


def _batches(files: DataFrame, max_bytes: int, max_files: int) -> Iterator[list[tuple]]:
    """Files in the order of their change, cut into batches; a larger file is a batch of its own."""
    batch, size = [], 0
    for row in files.orderBy("modified", "path").toLocalIterator():
        if batch and (size + row.length > max_bytes or len(batch) == max_files):
            yield batch
            batch, size = [], 0
        batch.append(tuple(row))
        size += row.length
    if batch:
        yield batch


def convert_changed_files(
    spark: SparkSession,
    dataset: str,
    in_path: str,
    out_path: str,
    ledger_path: str,
    source_db: str,
    target_db: str | None = None,
    target: Columns | None = None,
    partition_keys: str | Sequence[str] | None = None,
    options: ConversionOptions = ConversionOptions(),
    max_bytes_per_batch: int = 1 << 40,
    max_files_per_batch: int = 10_000,
) -> IncrementalRun:
    """Convert the files of ``in_path/<dataset>`` that are new or changed since the last run.

    Format, columns and target are as for ``convert_new_files``. All rows of a changed file are
    appended, as if it were a new file; rows that it had before stay. The driver holds
    the names of one batch, and Spark's listing of the files that are there. One run at a time
    uses a ledger, and files are not to change while they are read.
    """
    if options.mode != "append":
        raise ValueError(f"changed files are appended, mode {options.mode!r} is not possible")
    entry = describe_table(spark, f"{source_db}.{dataset}")
    if entry is None or not entry.is_text:
        raise ValueError(f"no such text table: {source_db}.{dataset}")
    table = None
    if target is None and target_db is not None:
        table = find_target(spark, target_db, dataset)
        target = table.columns if table is not None else None
    keys = keys_of_target(dataset, table, split_keys(partition_keys))
    require_keys(keys, [name for name, _ in entry.columns], dataset)
    read_path, write_path, path = (
        f"{base.rstrip('/')}/{dataset}" for base in (in_path, out_path, ledger_path)
    )
    ledger, total = FileLedger(spark, path), 0

    def finish(batch: int, rows: int) -> int:
        put_in_place(spark, ledger.staged_path(batch), write_path, table)
        ledger.note(batch, DONE, rows)
        return rows

    if ledger.waiting is not None:
        total += finish(*ledger.waiting)
    fresh = list_files(spark, read_path).join(ledger.known(), list(FILE), "left_anti")
    for files in _batches(fresh, max_bytes_per_batch, max_files_per_batch):
        batch = ledger.done + 1
        ledger.plan(batch, files)
        rows = scan_catalog_table(spark, entry, [exactly(file[0]) for file in files], options.extra_values)
        typed = cast_to_columns(
            rows, target or (), options.date_format, options.timestamp_format, declared=table is not None
        )
        staged = ledger.staged_path(batch)
        try:
            done = write_counted(typed, staged, options.compression, keys, "overwrite", options.rebalance)
        except Exception as error:
            if TOO_MANY_VALUES not in str(error):
                raise
            raise ExtraValues(dataset) from error
        ledger.note(batch, STAGED, done.rows)
        total += finish(batch, done.rows)
    return IncrementalRun(dataset, total, write_path)
