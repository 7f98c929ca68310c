"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder not used before, under ``spark.checkpoint.dir``.

    Without that setting a temporary folder is taken, on a local master only:
    executors of a cluster could not see it.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
