"""Conversion of files that arrived since the last run."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener
from pyspark.sql.types import StringType

from tableforge.names import Columns
from tableforge.operators.casting import cast_to_columns
from tableforge.operators.conversion import (
    ConversionOptions,
    find_target,
    keys_of_target,
    put_in_place,
)
from tableforge.sinks.parquet import (
    choose_codec,
    laid_out,
    require_keys,
    split_keys,
    write_counted,
)
from tableforge.sinks.publish import is_whole
from tableforge.sources.catalog import TableDescription, describe_table
from tableforge.sources.datasets import (
    TOO_MANY_VALUES,
    ExtraValues,
    declared_types,
    with_extra_values,
)
from tableforge.sources.text import UNEVEN_LINE, text_schema

# Every file counts, however old its time stamp is against files already seen.
ANY_AGE = "36500d"


@dataclass(frozen=True)
class IncrementalRun:
    dataset: str
    rows_read: int
    path: str


def convert_new_files(
    spark: SparkSession,
    dataset: str,
    in_path: str,
    out_path: str,
    checkpoint_path: str,
    source_db: str,
    target_db: str | None = None,
    target: Columns | None = None,
    partition_keys: str | Sequence[str] | None = None,
    options: ConversionOptions = ConversionOptions(),
    max_bytes_per_batch: int = 1 << 40,
) -> IncrementalRun:
    """Convert the files of ``in_path/<dataset>`` no earlier run has seen.

    The files have the format and columns of ``source_db.<dataset>``. The target
    columns are ``target``, or those of ``target_db.<dataset>``.

    The checkpoint remembers files. A declared target table shows the rows after the call: each
    batch is written whole beside the checkpoint, moved to the table's folder once, and the
    partitions it wrote are registered (no others are listed). A batch that is repeated
    after a failure goes on where it was. Without such a table the sink's log makes each
    file appear exactly once; give that output a folder of its own, as readers of a folder
    with such a log see only the files in it. ``max_bytes_per_batch`` bounds what a
    failure repeats. Files are always appended; another ``options.mode`` is refused.
    """
    if options.mode != "append":
        raise ValueError(f"new files are appended, mode {options.mode!r} is not possible")
    entry = describe_table(spark, f"{source_db}.{dataset}")
    if entry is None or not entry.is_text:
        raise ValueError(f"no such text table: {source_db}.{dataset}")
    table = None
    if target is None and target_db is not None:
        table = find_target(spark, target_db, dataset)
        target = table.columns if table is not None else None
    keys = keys_of_target(dataset, table, split_keys(partition_keys))
    read_path, write_path, checkpoint = (
        f"{base.rstrip('/')}/{dataset}" for base in (in_path, out_path, checkpoint_path)
    )
    schema = text_schema([name for name, _ in entry.columns])
    if options.extra_values != "ignore":
        schema = schema.add(UNEVEN_LINE, StringType())
    reader = (
        spark.readStream.schema(schema)
        .options(**entry.text_format.options())
        .option("columnNameOfCorruptRecord", UNEVEN_LINE)
        .option("recursiveFileLookup", True)
        .option("maxFileAge", ANY_AGE)
        .option("maxBytesPerTrigger", max_bytes_per_batch)
    )
    text = with_extra_values(reader.csv(read_path), entry.text_format, options.extra_values)
    typed = cast_to_columns(
        declared_types(text, entry),
        target or (),
        options.date_format,
        options.timestamp_format,
        declared=table is not None,
    )
    require_keys(keys, typed.columns, dataset)
    if table is not None:
        staged = f"{checkpoint.rstrip('/')}.staged"
        writer = typed.writeStream.foreachBatch(_commit(table, keys, staged, write_path, options))
        writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    else:
        writer = _file_sink(typed, keys, write_path, checkpoint, options)
    counter = _RowCounter()
    spark.streams.addListener(counter)
    try:
        query = writer.start()
        query.awaitTermination()
        rows = counter.total(str(query.runId))
    except StreamingQueryException as error:
        if TOO_MANY_VALUES in str(error):
            raise ExtraValues(dataset) from error
        raise
    finally:
        spark.streams.removeListener(counter)
        if table is not None:
            # Batches run in a session of their own, which keeps another list of files.
            spark.catalog.refreshTable(table.name)
    return IncrementalRun(dataset, rows, write_path)


def _file_sink(
    typed: DataFrame, keys: Sequence[str], write_path: str, checkpoint: str, options: ConversionOptions
) -> DataStreamWriter:
    writer = (
        (laid_out(typed, keys) if options.rebalance else typed)
        .writeStream.format("parquet")
        .option("path", write_path)
        .option("checkpointLocation", checkpoint)
        .option("compression", choose_codec(options.compression))
        .trigger(availableNow=True)
    )
    return writer.partitionBy(*keys) if keys else writer


def _commit(
    table: TableDescription,
    keys: Sequence[str],
    staged_base: str,
    write_path: str,
    options: ConversionOptions,
) -> Callable[[DataFrame, int], None]:
    def commit(batch: DataFrame, number: int) -> None:
        """Put the rows of a batch in place; a second call with its number changes nothing."""
        staged = f"{staged_base}/{number}"
        if not is_whole(batch.sparkSession, staged):
            write_counted(batch, staged, options.compression, keys, "overwrite", options.rebalance)
        put_in_place(batch.sparkSession, staged, write_path, table)

    return commit


class _RowCounter(StreamingQueryListener):
    """Rows read by each batch of each run; Spark itself keeps only the last batches."""

    def __init__(self) -> None:
        self._rows: dict[str, dict[int, int]] = {}
        self._changed = threading.Condition()
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        batch = event.progress
        with self._changed:
            rows = self._rows.setdefault(str(batch.runId), {})
            rows[batch.batchId] = max(batch.numInputRows, rows.get(batch.batchId, 0))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def total(self, run: str, timeout: float = 300) -> int:
        """Sum over all batches, once Spark has told of the end of the run."""
        with self._changed:
            if not self._changed.wait_for(lambda: run in self._ended, timeout):
                raise TimeoutError("the end of the streaming run was not reported")
            return sum(self._rows.get(run, {}).values())
