from __future__ import annotations

import os

import pytest
from conftest import values, write_lines

from tableforge import ConversionOptions, ExtraValues, convert_new_files, declare_database

SCHEMA = {"sales": "id INT, day DATE"}


@pytest.fixture
def raw(spark, folder, database) -> str:
    declare_database(spark, "raw", database, SCHEMA, f"{folder}/in")
    os.makedirs(f"{folder}/in/sales")
    return database


def run(spark, folder, raw, **kwargs):
    kwargs.setdefault("target", [("id", "int"), ("day", "date")])
    return convert_new_files(
        spark, "sales", f"{folder}/in", f"{folder}/out", f"{folder}/log", raw, **kwargs
    )


def rows(spark, folder):
    return sorted(values(spark.read.parquet(f"{folder}/out/sales").selectExpr("id", "CAST(day AS STRING)")))


def test_only_unseen_files(spark, folder, raw):
    write_lines(f"{folder}/in/sales", ["1|2024-01-01|", "2.5|bad|"])
    assert run(spark, folder, raw).rows_read == 2
    write_lines(f"{folder}/in/sales/deeper", ["3|2024-01-03"], "later.txt")
    assert run(spark, folder, raw).rows_read == 1
    assert run(spark, folder, raw).rows_read == 0
    assert rows(spark, folder) == [(1, "2024-01-01"), (2, None), (3, "2024-01-03")]


def test_old_time_stamps_are_not_left_out(spark, folder, raw):
    write_lines(f"{folder}/in/sales", ["1|2024-01-01"])
    run(spark, folder, raw)
    write_lines(f"{folder}/in/sales", ["2|2024-01-02"], "old.txt")
    os.utime(f"{folder}/in/sales/old.txt", (1_000_000_000, 1_000_000_000))
    assert run(spark, folder, raw).rows_read == 1
    assert [r[0] for r in rows(spark, folder)] == [1, 2]


def test_bounded_batches_read_everything_once(spark, folder, raw):
    for i in range(6):
        write_lines(f"{folder}/in/sales", [f"{i}|2024-01-01"] * 10, f"part-{i}.txt")
    done = run(spark, folder, raw, max_bytes_per_batch=250, partition_keys="day")
    assert done.rows_read == 60
    assert len(rows(spark, folder)) == 60
    offsets = [f for f in os.listdir(f"{folder}/log/sales/commits") if f.isdigit()]
    assert len(offsets) > 1


def test_target_of_the_catalog(spark, folder, raw):
    typed = f"{raw}_typed"
    spark.sql(f"CREATE DATABASE {typed} LOCATION '{folder}/{typed}'")
    declare_database(spark, "typed", typed, SCHEMA, f"{folder}/out")
    write_lines(f"{folder}/in/sales", ["1|2024-01-01"])
    run(spark, folder, raw, target=None, target_db=typed)
    assert spark.table(f"{typed}.sales").dtypes == [("id", "int"), ("day", "date")]
    assert rows(spark, folder) == [(1, "2024-01-01")]


def test_a_raw_table_is_needed(spark, folder, raw):
    with pytest.raises(ValueError, match="no such text table"):
        convert_new_files(spark, "other", folder, folder, folder, raw)


def test_one_file_for_each_small_key(spark, folder, raw):
    for i in range(8):
        write_lines(f"{folder}/in/sales", [f"{k}|2024-01-0{k}" for k in range(1, 6)], f"part-{i}.txt")
    assert run(spark, folder, raw, partition_keys="day").rows_read == 40
    for k in range(1, 6):
        files = os.listdir(f"{folder}/out/sales/day=2024-01-0{k}")
        assert len([name for name in files if name.endswith(".parquet")]) == 1


def test_rows_of_more_batches_than_spark_keeps(spark, folder, raw):
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "2")
    try:
        for i in range(5):
            write_lines(f"{folder}/in/sales", [f"{i}|2024-01-01"] * 3, f"part-{i}.txt")
        assert run(spark, folder, raw, max_bytes_per_batch=1).rows_read == 15
    finally:
        spark.conf.unset(key)


def test_other_modes_and_longer_rows_are_refused(spark, folder, raw):
    write_lines(f"{folder}/in/sales", ["1|2024-01-01|x"])
    with pytest.raises(ValueError, match="appended"):
        run(spark, folder, raw, options=ConversionOptions(mode="overwrite"))
    with pytest.raises(ExtraValues):
        run(spark, folder, raw)
    kept = run(spark, folder, raw, options=ConversionOptions(extra_values="keep"))
    assert kept.rows_read == 1
