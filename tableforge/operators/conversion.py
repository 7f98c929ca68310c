"""Conversion of text datasets to typed Parquet.

One dataset is one Spark job: scan, casts, row count and write in a single pass
over the text. Without partition keys nothing is shuffled.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tableforge.functions.casts import DATE_FORMAT, TIME_OF_DAY_FORMAT
from tableforge.names import Columns, column
from tableforge.operators.casting import cast_to_columns
from tableforge.operators.ledger import DONE, STAGED, STARTED, RunLedger, fingerprint
from tableforge.session import session_like
from tableforge.sinks.parquet import DEFAULT_CODEC, require_keys, split_keys, write_counted
from tableforge.sinks.publish import is_whole, partitions_in, publish
from tableforge.sources.catalog import (
    TableDescription,
    add_partitions,
    describe_table,
    list_datasets,
)
from tableforge.sources.datasets import TOO_MANY_VALUES, ExtraValues, lost_values, scan_dataset
from tableforge.sources.text import EXTRA_VALUES, TEXT_THERE, TextFormat

logger = logging.getLogger(__name__)

REPORT_SCHEMA = "dataset string, rows_read bigint"
LOST_SCHEMA = "lost map<string, bigint>"


@dataclass(frozen=True)
class ConversionOptions:
    """``text_format`` is for plain text; catalog tables bring their own.

    ``extra_values`` says what happens to values beyond the columns of a row: "error"
    writes nothing, "keep" adds a column ``extra_values`` with the list of them, "ignore"
    does not look (and reads no more columns than it must). ``count_losses`` counts, in the same
    pass, the values of each column that have text and end as NULL.
    """

    text_format: TextFormat = field(default_factory=TextFormat)
    compression: str = DEFAULT_CODEC
    mode: str = "append"
    date_format: str = DATE_FORMAT
    timestamp_format: str = TIME_OF_DAY_FORMAT
    rebalance: bool = True
    extra_values: str = "error"
    count_losses: bool = False


class ConversionFailed(RuntimeError):
    """A dataset failed. ``report`` has the rows of the datasets that are converted."""

    def __init__(self, dataset: str, report: list[tuple[str, int]]):
        super().__init__(f"{dataset} failed after {len(report)} converted datasets")
        self.dataset = dataset
        self.report = report


@dataclass(frozen=True)
class ConvertedDataset:
    dataset: str
    rows_read: int
    path: str
    schema: StructType
    #: Values lost in casts, by column, where ``count_losses`` asks for them; others are not named.
    lost: Mapping[str, int] = field(default_factory=dict, kw_only=True)
    spark: SparkSession = field(repr=False, compare=False)

    @cached_property
    def frame(self) -> DataFrame:
        """The Parquet files at ``path``, under the types they were written with."""
        files = self.spark.read.schema(self.schema).parquet(self.path)
        return files.select(*map(column, self.schema.names))


def convert_dataset(
    spark: SparkSession,
    dataset: str,
    in_path: str,
    out_path: str,
    source_db: str | None = None,
    target_db: str | None = None,
    target: Columns | None = None,
    partition_keys: str | Sequence[str] | None = None,
    options: ConversionOptions = ConversionOptions(),
    staged_path: str | None = None,
) -> ConvertedDataset:
    """Convert ``in_path/<dataset>`` to Parquet in ``out_path/<dataset>``.

    The target columns are ``target``, or those of ``target_db.<dataset>``.
    Without either nothing is cast.

    With ``staged_path`` the files are written whole to that folder first and not put in
    place: ``put_in_place`` does that, once.
    """
    read_path, write_path = (f"{base.rstrip('/')}/{dataset}" for base in (in_path, out_path))
    table = None
    if target is None and target_db is not None:
        table = find_target(spark, target_db, dataset)
        target = table.columns if table is not None else None
    names = None if target is None else [name for name, _ in target]
    keys = keys_of_target(dataset, table, split_keys(partition_keys))
    if table is not None and table.partition_columns:
        _require_known_order(spark, dataset, source_db, options.text_format)

    def scan(extra_values: str) -> DataFrame:
        return scan_dataset(
            spark,
            dataset,
            read_path,
            source_db,
            options.text_format,
            names,
            extra_values,
            options.count_losses,
        )

    typed = cast_to_columns(
        scan(options.extra_values),
        target or (),
        options.date_format,
        options.timestamp_format,
        declared=table is not None,
    )
    require_keys(keys, typed.columns, dataset)
    kept = [name for name in typed.columns if name not in (TEXT_THERE, EXTRA_VALUES)]
    try:
        done = write_counted(
            typed,
            staged_path or write_path,
            options.compression,
            keys,
            "overwrite" if staged_path else options.mode,
            options.rebalance,
            lost_values(kept) if options.count_losses else (),
            TEXT_THERE if options.count_losses else None,
        )
    except Exception as error:
        if TOO_MANY_VALUES not in str(error):
            raise
        # Nothing was written; say how many rows there are before anyone mends them.
        rows = scan("keep")
        # All columns are read, as Spark compares the width with the columns it reads.
        counts = rows.agg(F.count(EXTRA_VALUES), *(F.count(column(name)) for name in rows.columns))
        raise ExtraValues(dataset, counts.first()[0]) from error
    logger.info("%s: %d rows", dataset, done.rows)
    if table is not None and not staged_path:
        announce(spark, table, done.partitions)
    lost = {name: done.metrics.get(f"lost{k}") for k, name in enumerate(kept)}
    return ConvertedDataset(
        dataset,
        done.rows,
        staged_path or write_path,
        typed.drop(TEXT_THERE).schema,
        lost={name: number for name, number in lost.items() if number},
        spark=spark,
    )


def convert_database(
    spark: SparkSession,
    source_db: str,
    target_db: str,
    in_path: str,
    out_path: str,
    datasets: Sequence[str] | None = None,
    partition_keys: str | Sequence[str] | Mapping[str, str | Sequence[str]] | None = None,
    options: ConversionOptions = ConversionOptions(),
    ledger_path: str | None = None,
    at_once: int = 1,
) -> DataFrame:
    """Convert every table of ``source_db``, or the ``datasets`` named.

    Returns the report ``(dataset, rows_read)``. ``partition_keys`` apply to all
    datasets, or to the ones a mapping names. Keys of catalog tables are checked
    before the first dataset is read. A failure raises ``ConversionFailed`` with the
    report so far; give the other ``datasets`` to go on without converting any twice.

    With ``ledger_path`` the call is simply repeated after a failure. The ledger, a table for
    this output, has the state of each dataset and its files. What is done is not done again,
    unless the files have changed; what was written whole is only put in place; everything
    else begins anew in a folder of its own. The report has all datasets.

    ``at_once`` datasets are converted side by side, each from a thread and a session of its own, in
    a scheduler pool of its name. After a failure no further one begins, those that run are
    finished, and the report has all that are converted. With ``options.count_losses`` the report has
    a third column, ``lost``: values lost by column name (not with a ledger, which has no such count).
    """
    if ledger_path is not None and options.count_losses:
        raise ValueError("a run with a ledger does not count losses")
    if ledger_path is not None and options.mode != "append":
        raise ValueError(f"a run with a ledger appends, mode {options.mode!r} is not possible")
    names = list(datasets) if datasets is not None else list_datasets(spark, source_db)
    keys = {name: split_keys(_keys_of(partition_keys, name)) for name in names}
    for name in names:
        source = describe_table(spark, f"{source_db}.{name}") if keys[name] else None
        if source is not None:
            require_keys(keys[name], [column_name for column_name, _ in source.columns], name)
        if keys[name]:
            keys_of_target(name, describe_table(spark, f"{target_db}.{name}"), keys[name])
    ledger = None if ledger_path is None else RunLedger(spark, ledger_path)

    def convert(session: SparkSession, name: str, staged_path: str | None = None) -> ConvertedDataset:
        return convert_dataset(
            session,
            name,
            in_path,
            out_path,
            source_db=source_db,
            target_db=target_db,
            partition_keys=keys[name],
            options=options,
            staged_path=staged_path,
        )

    def row(session: SparkSession, name: str) -> tuple:
        if ledger is None:
            done = convert(session, name)
            return (name, done.rows_read, dict(done.lost))[: 3 if options.count_losses else 2]
        read_path, write_path = (f"{base.rstrip('/')}/{name}" for base in (in_path, out_path))
        table = describe_table(session, f"{target_db}.{name}")

        def stage(staged_path: str) -> int:
            return convert(session, name, staged_path).rows_read

        return name, _once(session, ledger, name, read_path, write_path, table, stage)

    if at_once > 1:
        report = _side_by_side(spark, names, row, at_once)
        for name in names:
            # The sessions of the threads keep other lists of files than this one.
            if spark.catalog.tableExists(f"{target_db}.{name}"):
                spark.catalog.refreshTable(f"{target_db}.{name}")
    else:
        report = []
        for name in names:
            try:
                report.append(row(spark, name))
            except Exception as error:
                raise ConversionFailed(name, report) from error
    logger.info("%d datasets converted", len(report))
    schema = f"{REPORT_SCHEMA}, {LOST_SCHEMA}" if options.count_losses else REPORT_SCHEMA
    return spark.createDataFrame(report, schema)


def _side_by_side(
    spark: SparkSession, names: Sequence[str], row: Callable[[SparkSession, str], tuple], at_once: int
) -> list[tuple]:
    """Report rows in the order of ``names``, from ``at_once`` threads."""
    failed = threading.Event()

    def work(name: str) -> tuple | None:
        if failed.is_set():
            return None
        session = session_like(spark)
        session.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return row(session, name)
        except Exception:
            failed.set()
            raise

    with ThreadPoolExecutor(at_once, "conversion") as threads:
        runs = [(name, threads.submit(work, name)) for name in names]
    report = [run.result() for _, run in runs if run.exception() is None]
    report = [found for found in report if found is not None]
    for name, run in runs:
        if run.exception() is not None:
            raise ConversionFailed(name, report) from run.exception()
    return report


def _once(
    spark: SparkSession,
    ledger: RunLedger,
    dataset: str,
    read_path: str,
    write_path: str,
    table: TableDescription | None,
    stage: Callable[[str], int],
) -> int:
    """Rows of ``dataset`` after the steps that the ledger does not have yet."""
    mark = fingerprint(spark, read_path)
    state, rows = ledger.state(dataset, mark)
    if state == DONE:
        return rows
    staged = ledger.staged_path(dataset, mark)
    if state != STAGED or not is_whole(spark, staged):
        ledger.note(dataset, mark, STARTED, None)
        rows = stage(staged)
        ledger.note(dataset, mark, STAGED, rows)
    put_in_place(spark, staged, write_path, table)
    ledger.note(dataset, mark, DONE, rows)
    return rows


def find_target(spark: SparkSession, target_db: str, dataset: str) -> TableDescription | None:
    """The table whose types a dataset is cast to; None, with a warning, without one."""
    table = describe_table(spark, f"{target_db}.{dataset}")
    if table is None:
        logger.warning("No target table %s.%s, nothing is cast", target_db, dataset)
    return table


def keys_of_target(
    dataset: str, table: TableDescription | None, keys: list[str]
) -> list[str]:
    """Partition keys of the output: those the target table declares, if there is one.

    Files under other keys would not be seen through the table, or in another order.
    """
    if table is None:
        return keys
    declared = list(table.partition_columns)
    if keys and keys != declared:
        by = ", ".join(declared) or "nothing"
        raise ValueError(f"{dataset}: {table.name} is partitioned by {by}, not by {', '.join(keys)}")
    return declared


def _keys_of(keys: str | Sequence[str] | Mapping | None, dataset: str) -> str | Sequence[str] | None:
    return keys.get(dataset) if isinstance(keys, Mapping) else keys


def _require_known_order(
    spark: SparkSession, dataset: str, source_db: str | None, text_format: TextFormat
) -> None:
    """A partitioned target lists its keys last, which tells nothing about the files."""
    declared = source_db is not None and spark.catalog.tableExists(f"{source_db}.{dataset}")
    if not declared and not text_format.header:
        raise ValueError(f"{dataset}: declare a raw table, its text has no header")


def announce(
    spark: SparkSession, table: TableDescription, partitions: Iterable[Sequence[str | None]]
) -> None:
    """Make new files visible through the declared table: those of ``partitions`` are new."""
    add_partitions(spark, table, partitions)
    spark.catalog.refreshTable(table.name)


def put_in_place(
    spark: SparkSession, staged_path: str, write_path: str, table: TableDescription | None
) -> None:
    """Move staged files to ``write_path`` and show them through ``table``.

    Partitions are registered before files are moved, so that a repeated call, which finds
    only the rest of the files, misses none.
    """
    if table is not None:
        add_partitions(spark, table, partitions_in(spark, staged_path, table.partition_columns))
    publish(spark, staged_path, write_path)
    if table is not None:
        spark.catalog.refreshTable(table.name)
