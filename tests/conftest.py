from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tableforge.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.checkpoint.dir": f"{scratch}/shared",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder(tmp_path: Path) -> str:
    return str(tmp_path)


@pytest.fixture
def database(spark: SparkSession, folder: str) -> str:
    """A database of its own for each test."""
    import uuid

    name = f"db_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/{name}'")
    return name


def write_lines(path: str, lines: list[str], name: str = "part-0.txt") -> str:
    """A text file in the folder ``path``."""
    Path(path).mkdir(parents=True, exist_ok=True)
    (Path(path) / name).write_text("".join(line + "\n" for line in lines), encoding="utf-8")
    return path


def values(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def plan_of(df, mode: str = "formatted") -> str:
    import contextlib
    import io

    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain(mode)
    return out.getvalue()
