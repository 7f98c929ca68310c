"""Ordered runs of SQL statements, with results written out and a report."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession

from tableforge.functions.script_text import PREVIEW_LENGTH
from tableforge.plans.scripts import read_scripts, statement_table
from tableforge.sinks.results import write_result
from tableforge.sources.catalog import use_database

logger = logging.getLogger(__name__)

REPORT_SCHEMA = "statement_no int, preview string, has_results boolean, row_count bigint"
DOUBLE_QUOTED_NAMES = "spark.sql.ansi.doubleQuotedIdentifiers"
#: Names of the commands that an INSERT becomes (fixed values).
WRITES_OF_INSERT = ("Execute Insert", "AppendData", "Overwrite")


@dataclass(frozen=True)
class BatchOptions:
    """``double_quoted_names`` reads ``"x"`` as a name; it is then no string.

    With ``quotes`` a script folder is taken apart with regard to quotes (see
    ``functions.script_text``).
    """

    database: str | None = None
    result_format: str = "csv"
    double_quoted_names: bool = False
    quotes: bool = False


class StatementFailed(RuntimeError):
    """A statement failed. ``report`` has the rows of the statements before it."""

    def __init__(self, statement_no: int, statement: str, report: list[tuple]):
        super().__init__(f"statement {statement_no} failed: {preview(statement)}")
        self.statement_no = statement_no
        self.report = report


def preview(statement: str) -> str:
    cut = statement[:PREVIEW_LENGTH]
    return cut if cut == statement else cut + "..."


def run_batch(
    spark: SparkSession,
    statements: Iterable[str],
    output_path: str | None = None,
    options: BatchOptions = BatchOptions(),
) -> DataFrame:
    """Run statements in order and return one report row for each.

    The rows of a statement with results go to ``output_path/<statement_no>``,
    or are only counted without an output path. Rows never pass the driver. The
    first failure ends the run.
    """
    report: list[tuple] = []
    with use_database(spark, options.database), _names_in_quotes(spark, options):
        for number, statement in enumerate(statements, start=1):
            logger.info("Statement %d: %s", number, preview(statement))
            try:
                has_results, rows = _run(spark, statement, number, output_path, options)
            except Exception as error:
                raise StatementFailed(number, statement, report) from error
            report.append((number, preview(statement), has_results, rows))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def run_script_folder(
    spark: SparkSession,
    path: str,
    output_path: str | None = None,
    options: BatchOptions = BatchOptions(),
) -> DataFrame:
    """Run the scripts below ``path``, by file name, as one batch."""
    found = statement_table(read_scripts(spark, path), quotes=options.quotes)
    table = found.orderBy("script_id", "statement_no")
    rows: Iterator[Row] = table.toLocalIterator()
    return run_batch(spark, (row["statement"] for row in rows), output_path, options)


def _run(
    spark: SparkSession,
    statement: str,
    number: int,
    output_path: str | None,
    options: BatchOptions,
) -> tuple[bool, int | None]:
    result = spark.sql(statement)
    if not result.columns:
        return False, inserted_rows(result)
    if output_path is None:
        return True, result.count()
    path = f"{output_path.rstrip('/')}/{number}"
    return True, write_result(result, path, options.result_format)


def inserted_rows(done: DataFrame) -> int | None:
    """Rows that the INSERTs of a statement have written, by the count of each write itself.

    ``done`` is the result of ``spark.sql``, which has run the statement. None for a
    statement without INSERT, and for a table whose connector does not count.
    """
    counts = [rows for rows in map(_rows_written, _commands(done)) if rows is not None]
    return sum(counts) if counts else None


def _commands(done: DataFrame) -> Iterator:
    """The commands of an executed statement: one, or several below a union."""
    todo = [done._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "CommandResultExec":
            todo.append(node.commandPhysicalPlan())
        elif kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind == "ResultQueryStageExec":
            todo.append(node.plan())
        elif kind == "UnionExec":
            children = node.children()
            todo += [children.apply(k) for k in range(children.size())]
        else:
            yield node


def _rows_written(command) -> int | None:
    rows = command.metrics().get("numOutputRows")
    inserts = command.nodeName().startswith(WRITES_OF_INSERT)
    return rows.get().value() if inserts and rows.isDefined() else None


@contextmanager
def _names_in_quotes(spark: SparkSession, options: BatchOptions) -> Iterator[None]:
    before = spark.conf.get(DOUBLE_QUOTED_NAMES)
    spark.conf.set(DOUBLE_QUOTED_NAMES, str(options.double_quoted_names).lower())
    try:
        yield
    finally:
        spark.conf.set(DOUBLE_QUOTED_NAMES, before)
