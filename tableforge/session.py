"""Session with the settings the library is laid out for."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

CLUSTER_SETTINGS = {
    # Text shrinks about four times as Parquet: 512 MB splits give ~128 MB files.
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.files.openCostInBytes": "8m",
    # Size of one file behind a rebalanced, partitioned write.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.shuffle.partitions": "4096",
}


def build_session(
    app_name: str = "tableforge",
    master: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session for ``master``; cluster sizes apply unless the master is local."""
    builder = SparkSession.builder.appName(app_name)
    settings = dict(SETTINGS)
    if master is not None:
        builder = builder.master(master)
    if master is None or not master.startswith("local"):
        settings.update(CLUSTER_SETTINGS)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


ANSI_MODE = "spark.sql.ansi.enabled"
_one_at_a_time = threading.RLock()


@contextmanager
def bad_casts_give_null(spark: SparkSession) -> Iterator[None]:
    """Build DataFrames inside whose casts give NULL instead of an error.

    The mode of a cast is fixed when the DataFrame is built, so it holds for
    every later use of the frame, whatever the session says then.
    """
    with _one_at_a_time:
        before = spark.conf.get(ANSI_MODE)
        spark.conf.set(ANSI_MODE, "false")
        try:
            yield
        finally:
            spark.conf.set(ANSI_MODE, before)


def session_like(spark: SparkSession) -> SparkSession:
    """A session of its own for another thread: the settings of ``spark``, without its views."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key) and other.conf.get(key, None) != value:
            other.conf.set(key, value)
    return other
