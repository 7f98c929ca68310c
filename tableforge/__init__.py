"""Turn folders of delimited text into typed Parquet tables, and query them, with Spark."""

from tableforge.operators.casting import cast_to_columns
from tableforge.operators.conversion import (
    ConversionFailed,
    ConversionOptions,
    ConvertedDataset,
    convert_database,
    convert_dataset,
)
from tableforge.plans.batch import BatchOptions, StatementFailed, run_batch, run_script_folder
from tableforge.plans.scripts import read_scripts, statement_table
from tableforge.session import build_session
from tableforge.sinks.parquet import write_parquet
from tableforge.sinks.results import write_result
from tableforge.sources.catalog import (
    declare_database,
    declare_parquet_table,
    declare_text_table,
    describe_table,
    drop_table,
    list_datasets,
    use_database,
)
from tableforge.sources.datasets import ExtraValues, scan_catalog_table, scan_dataset
from tableforge.sources.text import TextFormat, scan_text
from tableforge.streaming.file_ledger import convert_changed_files
from tableforge.streaming.incremental import IncrementalRun, convert_new_files

__all__ = [
    "BatchOptions",
    "ConversionFailed",
    "ConversionOptions",
    "ConvertedDataset",
    "ExtraValues",
    "IncrementalRun",
    "StatementFailed",
    "TextFormat",
    "build_session",
    "cast_to_columns",
    "convert_changed_files",
    "convert_database",
    "convert_dataset",
    "convert_new_files",
    "declare_database",
    "declare_parquet_table",
    "declare_text_table",
    "describe_table",
    "drop_table",
    "list_datasets",
    "read_scripts",
    "run_batch",
    "run_script_folder",
    "scan_catalog_table",
    "scan_dataset",
    "scan_text",
    "statement_table",
    "use_database",
    "write_parquet",
    "write_result",
]
