"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the number of local cores.
Text is derived from the tables before the clock starts; a timed conversion
scans it, casts it, writes Parquet and counts the rows. Each query runs once to
warm up and then ``BENCH_RUNS`` times; the fastest run counts.

The last two queries compare a conversion in one pass with one that counts first;
``BENCH_COPIES`` makes their text larger, and ``BENCH_ONLY`` selects queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import workload  # noqa: E402
from tableforge import build_session, cast_to_columns, scan_text, write_parquet  # noqa: E402
from tableforge.names import columns_of  # noqa: E402
from tableforge.session import bad_casts_give_null  # noqa: E402
from tableforge.sources.text import RAW_TABLE_FORMAT  # noqa: E402
from tableforge.workspace import new_folder  # noqa: E402
from workload.staging import TEXT_TABLES, as_text, staged_table, table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
ONLY = os.environ.get("BENCH_ONLY", "").split()

HEADLINES = [
    "count_all",
    "filter_project",
    "group_count_avg",
    "inner_join_filter",
    "scalar_subquery",
    "convert_orders",
    "convert_lineitem",
    "convert_cast_int",
    "convert_cast_date",
    "convert_gzip",
    "convert_partitioned_all",
    "convert_database",
    "convert_database_at_once",
    "convert_incremental",
    "script_statements",
    "sql_batch_report",
]


def lineitem_columns() -> list[tuple[str, str]]:
    return columns_of(TEXT_TABLES["lineitem"])


def lineitem_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan of the text of ``lineitem``, each row ``BENCH_COPIES`` times."""
    lines = as_text(table(spark, sf_dir, "lineitem"))
    if COPIES > 1:
        copies = F.explode(F.sequence(F.lit(1), F.lit(COPIES)))
        lines = lines.withColumn("copy", copies).drop("copy").repartition(2 * int(CPUS))
    folder = staged_table(spark, sf_dir, f"lineitem-{COPIES}", lines, RAW_TABLE_FORMAT)
    names = [name for name, _ in lineitem_columns()]
    return scan_text(spark, f"{folder}/lineitem-{COPIES}", RAW_TABLE_FORMAT, names)


def one_pass_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "one-pass")
    typed = cast_to_columns(lineitem_text(spark, sf_dir), lineitem_columns())
    write_parquet(typed, out)
    return spark.read.schema(typed.schema).parquet(out)


def two_pass_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For comparison: count in one job, cast by pattern and write in another."""
    rows, out = lineitem_text(spark, sf_dir), new_folder(spark, "two-pass")
    rows.count()
    with bad_casts_give_null(spark):
        for name, kind in lineitem_columns():
            value = F.to_date(name, "yyyy-MM-dd") if kind == "date" else F.col(name).cast(kind)
            rows = rows.withColumn(name, value)
    rows.write.parquet(out)
    return spark.read.schema(rows.schema).parquet(out)


def seconds(run: Callable[[], DataFrame]) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    extra = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": CPUS,
    }
    spark = build_session("bench", f"local[{CPUS}]", extra)
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: workload.QUERIES[name] for name in HEADLINES}
    queries |= {"one_pass_lineitem": one_pass_lineitem, "two_pass_lineitem": two_pass_lineitem}
    if ONLY:
        queries = {name: query for name, query in queries.items() if name in ONLY}
    headlines = [name for name in HEADLINES if name in queries]
    times = {}
    for name, query in queries.items():
        runs = [seconds(lambda: query(spark, SF_DIR)) for _ in range(RUNS + 1)]
        times[name] = round(min(runs[1:]), 3)
        print(f"{name}: {times[name]} s", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times[name] for name in headlines), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
