"""Datasets side by side, and values that casts lose."""

from __future__ import annotations

import os

import pytest
from conftest import plan_of, values, write_lines

from tableforge import ConversionFailed, ConversionOptions, convert_database, convert_dataset, declare_database
from tableforge.session import session_like
from tableforge.sources.datasets import scan_dataset

SCHEMAS = {f"t{k}": "id INT, day DATE, price DECIMAL(5,2)" for k in range(6)}


@pytest.fixture
def pair(spark, folder, database):
    typed = f"{database}_typed"
    declare_database(spark, "raw", database, SCHEMAS, f"{folder}/in")
    declare_database(spark, "typed", typed, SCHEMAS, f"{folder}/out", partition_by={"t1": ["day"]})
    for k, name in enumerate(SCHEMAS):
        write_lines(f"{folder}/in/{name}", ["1|2024-01-01|1.5", "x|bad|", "|2024-1-1|12345.6"][: k % 3 + 1])
    return database, typed, f"{folder}/in", f"{folder}/out"


def test_order_and_readers(spark, pair):
    assert spark.table(f"{pair[1]}.t1").count() == 0
    report = convert_database(spark, *pair, at_once=3)
    assert values(report) == [(name, k % 3 + 1) for k, name in enumerate(SCHEMAS)]
    for k, name in enumerate(SCHEMAS):
        assert spark.table(f"{pair[1]}.{name}").count() == k % 3 + 1
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_failure_begins_no_more(spark, folder, pair):
    write_lines(f"{folder}/in/t1", ["1|2|3|4"], "wide.txt")
    with pytest.raises(ConversionFailed) as failure:
        convert_database(spark, *pair, at_once=2)
    done = dict(failure.value.report)
    assert failure.value.dataset == "t1" and "t1" not in done and done["t0"] == 1
    written = {name for name in SCHEMAS if os.path.exists(f"{folder}/out/{name}/_SUCCESS")}
    assert written == set(done) and len(done) < 5


def test_a_ledger_of_threads_is_whole(spark, folder, pair):
    for _ in range(2):
        report = convert_database(spark, *pair, at_once=6, ledger_path=f"{folder}/ledger")
        assert dict(values(report)) == {name: k % 3 + 1 for k, name in enumerate(SCHEMAS)}
    assert spark.table(f"{pair[1]}.t5").count() == 3
    assert spark.read.parquet(f"{folder}/ledger/steps").where("state = 'done'").count() == 6


def test_lost_values_by_column(spark, folder, pair):
    options = ConversionOptions(count_losses=True, extra_values="keep")
    write_lines(f"{folder}/in/t5", ["|||more", " |2024-01-01|1"], "extra.txt")
    report = convert_database(spark, *pair, datasets=["t0", "t1", "t5"], options=options)
    assert values(report) == [
        ("t0", 1, {}), ("t1", 2, {"id": 1, "day": 1}), ("t5", 5, {"id": 2, "day": 2, "price": 1}),
    ]
    done = convert_dataset(
        spark, "t2", pair[2], f"{folder}/plain", target=[("id", "int")],
        options=ConversionOptions(count_losses=True, text_format=ConversionOptions().text_format),
    )
    assert done.frame.columns == done.schema.names and "__text_there" not in done.schema.names
    with pytest.raises(ValueError, match="ledger"):
        convert_database(spark, *pair, options=options, ledger_path=f"{folder}/ledger")


def test_losses_need_no_second_scan(spark, pair):
    rows = scan_dataset(spark, "t1", f"{pair[2]}/t1", pair[0], extra_values="error", text_there=True)
    plan = plan_of(rows)
    assert plan.count("Scan csv") == plan_of(rows.drop("__text_there")).count("Scan csv") and "Exchange" not in plan


def test_sessions_of_threads_have_the_settings(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        assert session_like(spark).conf.get("spark.sql.shuffle.partitions") == "5"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
