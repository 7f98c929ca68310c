"""Ledger of a conversion run: which dataset, of which files, is how far."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

STARTED, STAGED, DONE = "started", "staged", "done"
LEDGER_SCHEMA = "step bigint, dataset string, files string, state string, rows_read bigint"


def fingerprint(spark: SparkSession, path: str) -> str:
    """Number, size and a digest of the names, sizes and times of the files below ``path``.

    The listing is a DataFrame; no file is opened, and one row comes to the driver.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    count, size, digest = files.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.sum(one), F.lit(0))
    ).first()
    return f"{count}-{size}-{int(digest) % (1 << 64):016x}"


class RunLedger:
    """A Parquet table below ``path``; each step of a dataset adds a row, none is changed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        # Two writes into one folder at a time would take each other's files away.
        self._one_at_a_time = threading.Lock()
        self.spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").parquet(f"{self.path}/steps")
        steps = spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.path}/steps")
        last = steps.groupBy("dataset", "files").agg(F.max_by(F.struct("state", "rows_read"), "step").alias("last"))
        # A row for each dataset and state of its files.
        self.known = {(row.dataset, row.files): tuple(row.last) for row in last.collect()}
        self.step = steps.agg(F.max("step")).first()[0] or 0

    def state(self, dataset: str, files: str) -> tuple[str | None, int | None]:
        return self.known.get((dataset, files), (None, None))

    def note(self, dataset: str, files: str, state: str, rows: int | None) -> None:
        with self._one_at_a_time:
            self.step += 1
            row = self.spark.createDataFrame([(self.step, dataset, files, state, rows)], LEDGER_SCHEMA)
            row.coalesce(1).write.mode("append").parquet(f"{self.path}/steps")
            self.known[dataset, files] = (state, rows)

    def staged_path(self, dataset: str, files: str) -> str:
        return f"{self.path}/staged/{dataset}-{files}"
