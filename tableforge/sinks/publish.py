"""Output that is written whole beside its place, and then moved there once.

A folder that Spark has finished writing bears a mark. Moving begins only then, and a file is
either still in the staged folder or already in its place, so a move that was interrupted is
simply repeated. Only names pass through the driver, those of one write.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession

#: Name of the folder of null (and empty) partition values (fixed value).
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
FINISHED = "_SUCCESS"


def _paths(spark: SparkSession, folder: str):
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    folder_path = path_of(folder)
    return path_of, folder_path, folder_path.getFileSystem(spark._jsc.hadoopConfiguration())


def is_whole(spark: SparkSession, staged: str) -> bool:
    """Whether a write into ``staged`` has ended."""
    path_of, folder, files = _paths(spark, staged)
    return files.exists(path_of(folder, FINISHED))


def _is_data(name: str) -> bool:
    return not name.startswith((".", "_")) or "=" in name


def partitions_in(spark: SparkSession, staged: str, keys: Sequence[str]) -> list[tuple[str | None, ...]]:
    """Partition values of the folders below ``staged``; None for those without a value."""
    _, folder, files = _paths(spark, staged)

    def below(path, depth: int) -> Iterator[tuple[str | None, ...]]:
        if depth == len(keys):
            yield ()
            return
        for status in files.listStatus(path):
            name = status.getPath().getName()
            if status.isDirectory() and _is_data(name):
                value = unquote(name.partition("=")[2])
                for rest in below(status.getPath(), depth + 1):
                    yield (None if value == NO_VALUE else value, *rest)

    return list(below(folder, 0)) if keys else []


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Move what is in ``staged`` to ``target``, next to what is there; folders are joined."""
    path_of, source, files = _paths(spark, staged)

    def move(folder, goal) -> None:
        for status in files.listStatus(folder):
            path = status.getPath()
            place = path_of(goal, path.getName())
            if not _is_data(path.getName()):
                continue
            if status.isDirectory() and files.exists(place):
                move(path, place)
            elif not files.rename(path, place):
                raise OSError(f"{path} could not be moved to {place}")

    goal = path_of(target)
    files.mkdirs(goal)
    move(source, goal)
