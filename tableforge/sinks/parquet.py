"""Parquet output: codec, partitions and the layout of files."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tableforge.names import column

logger = logging.getLogger(__name__)

# Codecs of the conversion.
CODECS = ("snappy", "gzip", "none")
DEFAULT_CODEC = "snappy"
#: Hadoop setting: a folder gets a mark when a write into it has ended.
MARK_FINISHED = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
#: Mode of a write that replaces the partitions it has rows for.
REPLACE_PARTITIONS = "replace_partitions"


def choose_codec(name: str) -> str:
    codec = name.strip().lower()
    if codec in CODECS:
        return codec
    logger.warning("Unknown compression %r, using %s", name, DEFAULT_CODEC)
    return DEFAULT_CODEC


def split_keys(keys: str | Sequence[str] | None) -> list[str]:
    """Partition keys from a comma-separated list or a sequence, blanks removed."""
    parts = keys.split(",") if isinstance(keys, str) else (keys or ())
    return [part.strip() for part in parts if part.strip()]


def require_keys(keys: Sequence[str], columns: Sequence[str], dataset: str) -> None:
    missing = [key for key in keys if key not in columns]
    if missing:
        raise ValueError(f"{dataset}: no column for partition key {', '.join(missing)}")


def laid_out(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring rows of one partition value together before a partitioned write.

    Otherwise each of N tasks writes a file for each of M values. The rebalance
    is by size: a value that holds much of the data is split over many tasks,
    and small ones share a task.
    """
    return df.hint("rebalance", *map(column, keys)) if keys else df


@dataclass(frozen=True)
class Written:
    """Rows of a write, the partitions it wrote to (values as text, None for null), and ``metrics``."""

    rows: int
    partitions: tuple[tuple[str | None, ...], ...] = ()
    metrics: Mapping[str, int] = field(default_factory=dict)


def write_counted(
    df: DataFrame,
    path: str,
    compression: str = DEFAULT_CODEC,
    partition_keys: str | Sequence[str] | None = None,
    mode: str = "append",
    rebalance: bool = True,
    extra_metrics: Sequence[Column] = (),
    helper: str | None = None,
) -> Written:
    """Write ``df``; its rows and partitions are counted by the write itself.

    The count sits above the rebalance, in the writing stage. A lost executor
    repeats tasks of that stage, and Spark adds the counter of each task once.
    With the mode "replace_partitions" the partitions written to lose what they had, and
    others stay. ``extra_metrics`` are aggregates counted with the rows; the column ``helper``, which
    only they need, is not written.
    """
    keys = split_keys(partition_keys)
    require_keys(keys, df.columns, path)
    if mode == REPLACE_PARTITIONS and not keys:
        raise ValueError(f"{path}: only a partitioned write can replace partitions")
    counter = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if keys:
        values = [column(key).cast("string").alias(f"k{n}") for n, key in enumerate(keys)]
        metrics.append(F.collect_set(F.struct(*values)).alias("partitions"))
    rows = (laid_out(df, keys) if rebalance else df).observe(counter, *metrics, *extra_metrics)
    rows = rows.drop(helper) if helper else rows
    writer = rows.write.option("compression", choose_codec(compression)).option(MARK_FINISHED, "true")
    if mode == REPLACE_PARTITIONS:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode).option("partitionOverwriteMode", "static")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(path)
    found = dict(counter.get)
    written = found.pop("rows"), tuple(map(tuple, found.pop("partitions", None) or ()))
    return Written(*written, found)


def write_parquet(
    df: DataFrame,
    path: str,
    compression: str = DEFAULT_CODEC,
    partition_keys: str | Sequence[str] | None = None,
    mode: str = "append",
    rebalance: bool = True,
) -> int:
    """Write ``df`` and return the number of rows."""
    return write_counted(df, path, compression, partition_keys, mode, rebalance).rows
