from __future__ import annotations

import logging
from pathlib import Path

import pytest
from conftest import values
from pyspark.sql import functions as F

from tableforge import write_parquet, write_result
from tableforge.sinks.parquet import choose_codec, split_keys


def files(path: str, suffix: str = ".parquet") -> list[Path]:
    return [f for f in Path(path).rglob("*") if f.name.endswith(suffix) and f.name[0] not in "._"]


@pytest.mark.parametrize(
    ("codec", "suffix"),
    [("snappy", ".snappy.parquet"), ("GZIP", ".gz.parquet"), ("none", ".parquet")],
)
def test_codecs(spark, folder, codec, suffix):
    assert write_parquet(spark.range(5), f"{folder}/out", codec) == 5
    written = files(f"{folder}/out")
    assert written and all(f.name.endswith(suffix) for f in written)
    if codec == "none":
        assert not [f for f in written if ".snappy." in f.name or ".gz." in f.name]


def test_unknown_codec(spark, folder, caplog):
    with caplog.at_level(logging.WARNING):
        assert choose_codec("zip9") == "snappy"
    assert "zip9" in caplog.text


def test_key_lists():
    assert split_keys(" year, month ,,") == ["year", "month"]
    assert split_keys(["a ", ""]) == ["a"]
    assert split_keys("") == split_keys(None) == []


def test_partitioned_write(spark, folder):
    rows = spark.range(100).select("id", (F.col("id") % 3).alias("a"), F.lit("x y").alias("b"))
    assert write_parquet(rows, f"{folder}/out", partition_keys="a , b") == 100
    folders = {str(f.parent.relative_to(f"{folder}/out")) for f in files(f"{folder}/out")}
    assert folders == {f"a={i}/b=x y" for i in range(3)}
    assert sorted(values(spark.read.parquet(f"{folder}/out").select("id"))) == [
        (i,) for i in range(100)
    ]


def test_one_file_per_small_partition(spark, folder):
    """Rows of a key come together instead of leaving a file from every task."""
    rows = spark.range(0, 800, 1, 8).select("id", (F.col("id") % 5).alias("k"))
    write_parquet(rows, f"{folder}/together", partition_keys="k")
    write_parquet(rows, f"{folder}/apart", partition_keys="k", rebalance=False)
    assert len(files(f"{folder}/together")) == 5
    assert len(files(f"{folder}/apart")) == 40


def test_hot_key_is_split_over_tasks(spark, folder):
    """A key with most of the rows is written by several tasks, each row once."""
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.col("id").substr(1, 1)).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1m")
    try:
        assert write_parquet(rows, f"{folder}/out", partition_keys="k") == 400_000
    finally:
        spark.conf.set(setting, before)
    assert len(files(f"{folder}/out/k=hot")) > 3
    written = spark.read.parquet(f"{folder}/out")
    assert written.count() == written.select("v").distinct().count() == 400_000


def test_missing_partition_key(spark, folder):
    with pytest.raises(ValueError, match="nope"):
        write_parquet(spark.range(1), f"{folder}/out", partition_keys="id,nope")
    assert not Path(f"{folder}/out").exists()


def test_modes(spark, folder):
    for expected in (3, 6):
        write_parquet(spark.range(3), f"{folder}/out")
        assert spark.read.parquet(f"{folder}/out").count() == expected
    write_parquet(spark.range(2), f"{folder}/out", mode="overwrite")
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_no_rows(spark, folder):
    assert write_parquet(spark.range(0), f"{folder}/out") == 0
    empty = spark.range(0).select("id", F.lit("x").alias("k"))
    assert write_parquet(empty, f"{folder}/keys", partition_keys="k") == 0


def test_result_as_text(spark, folder):
    rows = spark.sql("SELECT 1 AS a, ' x, \"y\" ' AS b, array(1, 2) AS c, named_struct('n', 1) AS d")
    assert write_result(rows, f"{folder}/out") == 1
    read = spark.read.csv(f"{folder}/out", header=True)
    assert read.columns == ["a", "b", "c", "d"]
    assert values(read) == [("1", ' x, "y" ', "[1,2]", '{"n":1}')]


def test_result_with_equal_names(spark, folder):
    rows = spark.sql("SELECT 1 AS a, 2 AS A, 3 AS a, 4 AS `b.c`")
    for result_format in ("csv", "parquet"):
        path = f"{folder}/{result_format}"
        assert write_result(rows, path, result_format) == 1
        read = spark.read.load(path, format=result_format, header=True)
        assert read.columns == ["a", "A_2", "a_3", "b.c"]


def test_result_format_is_checked(spark, folder):
    with pytest.raises(ValueError, match="orc"):
        write_result(spark.range(1), folder, "orc")
