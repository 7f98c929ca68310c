from __future__ import annotations

import datetime
import logging
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import plan_of, values, write_lines
from pyspark.errors import AnalysisException

from tableforge import (
    ConversionFailed,
    ConversionOptions,
    ExtraValues,
    TextFormat,
    cast_to_columns,
    convert_database,
    convert_dataset,
    declare_database,
    declare_text_table,
    scan_dataset,
    scan_text,
    write_parquet,
)
from tableforge.names import columns_of
from tableforge.session import bad_casts_give_null

SCHEMA = "id INT, price DECIMAL(7,2), day DATE, note STRING"
LINES = ["1|10.5|2024-01-01|a|", "x|abc|2024-1-1||", "3.9|2|2024-12-31|c| |"]
ROWS = [
    (1, Decimal("10.50"), datetime.date(2024, 1, 1), "a"),
    (None, None, None, None),
    (3, Decimal("2.00"), datetime.date(2024, 12, 31), "c"),
]


@pytest.fixture
def pair(spark, folder, database) -> tuple[str, str, str, str]:
    """Raw and typed database with one table ``sales``, and the two base paths."""
    text, parquet = f"{folder}/text", f"{folder}/parquet"
    typed = f"{database}_typed"
    spark.sql(f"CREATE DATABASE {typed} LOCATION '{folder}/{typed}'")
    declare_database(spark, "raw", database, {"sales": SCHEMA}, text)
    declare_database(spark, "typed", typed, {"sales": SCHEMA}, parquet)
    write_lines(f"{text}/sales", LINES)
    return database, typed, text, parquet


def test_dataset_between_declared_tables(spark, pair):
    raw, typed, text, parquet = pair
    done = convert_dataset(spark, "sales", text, parquet, raw, typed)
    assert (done.dataset, done.rows_read) == ("sales", 3)
    assert done.path == f"{parquet}/sales"
    assert sorted(values(done.frame), key=str) == sorted(ROWS, key=str)
    assert sorted(values(spark.table(f"{typed}.sales")), key=str) == sorted(ROWS, key=str)


def test_values_beyond_the_columns(spark, pair):
    """They stop the conversion before anything is written, or are kept."""
    raw, typed, text, parquet = pair
    write_lines(f"{text}/sales", ["4|1|2024-01-01|e|x|y", "5|1|2024-01-01|f||z", "6|1"], "more.txt")
    with pytest.raises(ExtraValues, match="sales: 2 rows") as failure:
        convert_dataset(spark, "sales", text, parquet, raw, typed)
    assert failure.value.rows == 2
    assert not list(Path(parquet).rglob("*.parquet"))
    options = ConversionOptions(extra_values="keep")
    kept = convert_dataset(spark, "sales", text, f"{parquet}/kept", raw, typed, options=options).frame
    found = {row["id"]: row["extra_values"] for row in kept.collect() if row["id"] is not None}
    assert found == {1: None, 3: None, 4: ["x", "y"], 5: ["z"], 6: None}
    options = ConversionOptions(extra_values="ignore")
    assert convert_dataset(spark, "sales", text, f"{parquet}/cut", raw, options=options).rows_read == 6


def test_values_beyond_the_columns_of_quoted_text(spark, folder):
    lines = ["1,\"a,b\"", "2,c,\"d,e\",f", "3,\"g\",,"]
    write_lines(f"{folder}/t", lines)
    options = ConversionOptions(extra_values="keep")
    kept = convert_dataset(spark, "t", folder, f"{folder}/out", options=options).frame
    assert sorted(map(str, values(kept))) == sorted(
        map(str, [("1", "a,b", None), ("2", "c", ["d,e", "f"]), ("3", "g", None)])
    )


def test_declared_partition_keys_are_used(spark, folder, database):
    text, parquet = f"{folder}/text", f"{folder}/parquet"
    typed = f"{database}_typed"
    spark.sql(f"CREATE DATABASE {typed} LOCATION '{folder}/{typed}'")
    schemas = {"sales": "a INT, k INT, v STRING"}
    declare_database(spark, "raw", database, schemas, text)
    declare_database(spark, "typed", typed, schemas, parquet, partition_by={"sales": ["k"]})
    write_lines(f"{text}/sales", ["1|7|x", "2|8|y", "3|7|z"])
    for keys in ("a", "k,a"):
        with pytest.raises(ValueError, match="is partitioned by k, not by"):
            convert_dataset(spark, "sales", text, parquet, database, typed, partition_keys=keys)
    convert_dataset(spark, "sales", text, parquet, database, typed)
    found = spark.table(f"{typed}.sales").select("a", "k", "v")
    assert sorted(values(found)) == [(1, 7, "x"), (2, 8, "y"), (3, 7, "z")]


def test_flat_target_takes_no_keys(spark, pair):
    raw, typed, text, parquet = pair
    with pytest.raises(ValueError, match="is partitioned by nothing, not by note"):
        convert_dataset(spark, "sales", text, parquet, raw, typed, partition_keys="note")


def test_report_of_a_failed_database(spark, folder, database):
    """What is left can be converted without doubling what is done."""
    text, parquet = f"{folder}/text", f"{folder}/parquet"
    declare_database(spark, "raw", database, {name: "id INT" for name in "abc"}, text)
    for name, line in (("a", "1"), ("b", "2|3"), ("c", "4")):
        write_lines(f"{text}/{name}", [line])
    with pytest.raises(ConversionFailed, match="b failed after 1") as failure:
        convert_database(spark, database, "none", text, parquet)
    assert (failure.value.dataset, failure.value.report) == ("b", [("a", 1)])
    write_lines(f"{text}/b", ["2"])
    report = convert_database(spark, database, "none", text, parquet, ["b", "c"])
    assert values(report) == [("b", 1), ("c", 1)]
    assert [spark.read.parquet(f"{parquet}/{name}").count() for name in "abc"] == [1, 1, 1]


def test_header_with_equal_names(spark, folder):
    write_lines(f"{folder}/t", ["a,a", "1,2"])
    options = ConversionOptions(text_format=TextFormat(header=True))
    done = convert_dataset(spark, "t", folder, f"{folder}/out", options=options)
    assert values(done.frame) == [("1", "2")]


def test_types_without_a_cast_are_refused(spark, folder, database):
    spark.sql(f"CREATE TABLE {database}.t (a ARRAY<INT>) USING parquet")
    write_lines(f"{folder}/t", ["1"])
    with pytest.raises(ValueError, match="no cast from string to array<int>"):
        convert_dataset(spark, "t", folder, f"{folder}/out", target_db=database)
    assert not (Path(folder) / "out").exists()


def test_append_and_overwrite(spark, pair):
    raw, typed, text, parquet = pair
    for expected in (3, 6):
        convert_dataset(spark, "sales", text, parquet, raw, typed)
        assert spark.table(f"{typed}.sales").count() == expected
    options = ConversionOptions(mode="overwrite")
    convert_dataset(spark, "sales", text, parquet, raw, typed, options=options)
    assert spark.table(f"{typed}.sales").count() == 3


def test_no_target_table(spark, pair, caplog):
    raw, typed, text, parquet = pair
    write_lines(f"{text}/extra", ["1,2"])
    with caplog.at_level(logging.WARNING):
        done = convert_dataset(spark, "extra", text, parquet, raw, typed)
    assert "nothing is cast" in caplog.text and "plain text" in caplog.text
    assert done.frame.dtypes == [("_c0", "string"), ("_c1", "string")]


def test_raw_types_hold_without_a_target(spark, pair):
    raw, _, text, parquet = pair
    done = convert_dataset(spark, "sales", text, parquet, raw)
    assert done.frame.dtypes == [
        ("id", "int"),
        ("price", "decimal(7,2)"),
        ("day", "string"),
        ("note", "string"),
    ]


def test_plain_text_with_and_without_header(spark, folder):
    write_lines(f"{folder}/t", ["7,2024-01-01,z"])
    done = convert_dataset(
        spark, "t", folder, f"{folder}/out", target=[("id", "int"), ("day", "date")]
    )
    assert done.frame.dtypes == [("id", "int"), ("day", "date"), ("_c2", "string")]
    write_lines(f"{folder}/h", ["day,extra,id", "2024-01-01,z,7"])
    done = convert_dataset(
        spark,
        "h",
        folder,
        f"{folder}/out",
        target=[("id", "int"), ("absent", "int"), ("day", "date")],
        options=ConversionOptions(text_format=TextFormat(header=True)),
    )
    assert done.frame.dtypes == [("day", "date"), ("extra", "string"), ("id", "int")]
    assert values(done.frame) == [(datetime.date(2024, 1, 1), "z", 7)]


def test_partitions_keep_types_and_order(spark, folder):
    write_lines(f"{folder}/t", ["007,1,a", "007,2,b", ",3,c"])
    done = convert_dataset(
        spark,
        "t",
        folder,
        f"{folder}/out",
        target=[("code", "string"), ("n", "int"), ("s", "string")],
        partition_keys="code",
    )
    assert done.frame.columns == ["code", "n", "s"]
    assert sorted(values(done.frame), key=str) == [("007", 1, "a"), ("007", 2, "b"), (None, 3, "c")]


def test_partitioned_target_shows_new_rows(spark, folder, database):
    text, parquet, typed = f"{folder}/text", f"{folder}/parquet", f"{database}_typed"
    spark.sql(f"CREATE DATABASE {typed} LOCATION '{folder}/{typed}'")
    schemas = {"t": "k STRING, v INT"}
    declare_database(spark, "raw", database, schemas, text)
    declare_database(spark, "typed", typed, schemas, parquet, partition_by={"t": ["k"]})
    write_lines(f"{text}/t", ["a|1", "b|2"])
    convert_dataset(spark, "t", text, parquet, database, typed, partition_keys=["k"])
    assert sorted(values(spark.table(f"{typed}.t").select("k", "v"))) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError, match="raw table"):
        convert_dataset(spark, "t", text, parquet, None, typed, partition_keys=["k"])


def test_database_report_in_order_of_names(spark, folder, database):
    text, parquet = f"{folder}/text", f"{folder}/parquet"
    schemas = {name: "id INT" for name in ("c", "a", "b")}
    declare_database(spark, "raw", database, schemas, text)
    for count, name in enumerate(schemas, start=1):
        write_lines(f"{text}/{name}", ["1"] * count)
    report = convert_database(spark, database, "nowhere_typed", text, parquet)
    assert values(report) == [("a", 2), ("b", 3), ("c", 1)]
    some = convert_database(spark, database, "nowhere_typed", text, parquet, datasets=["c", "b"])
    assert values(some) == [("c", 1), ("b", 3)]


def test_keys_of_every_dataset_are_checked_first(spark, folder, database):
    text, parquet = f"{folder}/text", f"{folder}/parquet"
    declare_database(spark, "raw", database, {"a": "id INT, k INT", "b": "id INT"}, text)
    write_lines(f"{text}/a", ["1|2"])
    write_lines(f"{text}/b", ["1"])
    with pytest.raises(ValueError, match="b: no column for partition key k"):
        convert_database(spark, database, "none", text, parquet, partition_keys="k")
    assert not Path(parquet).exists()
    report = convert_database(spark, database, "none", text, parquet, partition_keys={"a": "k"})
    assert values(report) == [("a", 1), ("b", 1)]
    assert (Path(parquet) / "a" / "k=2").is_dir()


def test_errors_surface(spark, pair):
    raw, typed, text, parquet = pair
    with pytest.raises(AnalysisException):
        convert_dataset(spark, "sales", f"{text}/absent", parquet, raw, typed)


def test_one_scan_and_no_shuffle(spark, pair, folder):
    """Casting and counting happen in the pass that writes."""
    raw, _, text, _ = pair
    typed = cast_to_columns(scan_dataset(spark, "sales", f"{text}/sales", raw), columns_of(SCHEMA))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-pass", "conversion")
    try:
        assert write_parquet(typed, f"{folder}/out") == 3
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup("one-pass")]
    assert [len(job.stageIds) for job in jobs] == [1]
    plan = plan_of(typed, "simple")
    assert plan.count("FileScan csv") == 1
    assert "Exchange" not in plan and "Python" not in plan


def test_whole_numbers_equal_a_session_that_gives_null(spark, folder):
    texts = ["12", " 12 ", "12.7", "-0.5", "1e2", "1,0", "99999999999", "--1", "+", "0x1F", "٣", "1 2"]
    write_lines(f"{folder}/n", [f"{t}|{t}|{t}|{t}" for t in texts])
    text_format = TextFormat(sep="|", quote="")
    plain = scan_text(spark, f"{folder}/n", text_format, ["i", "l", "d", "m"])
    with bad_casts_give_null(spark):
        expected = plain.selectExpr(
            "CAST(i AS INT)", "CAST(l AS BIGINT)", "CAST(d AS DOUBLE)", "CAST(m AS DECIMAL(7,2))"
        )
    done = convert_dataset(
        spark,
        "n",
        folder,
        f"{folder}/out",
        target=[("i", "int"), ("l", "bigint"), ("d", "double"), ("m", "decimal(7,2)")],
        options=ConversionOptions(text_format=text_format),
    )
    assert sorted(values(done.frame), key=str) == sorted(values(expected), key=str)


def test_declared_format_wins_over_the_plain_one(spark, folder, database):
    declare_text_table(spark, f"{database}.t", "a INT, b INT", folder, TextFormat(sep=";"))
    write_lines(f"{folder}/in/t", ["1;2"])
    done = convert_dataset(spark, "t", f"{folder}/in", f"{folder}/out", database)
    assert values(done.frame) == [(1, 2)]
