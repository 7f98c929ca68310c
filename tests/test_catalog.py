from __future__ import annotations

import re
from pathlib import Path

import pytest
from conftest import ROOT, values, write_lines

from tableforge import (
    convert_database,
    declare_database,
    declare_parquet_table,
    declare_text_table,
    describe_table,
    drop_table,
    list_datasets,
    use_database,
)
from tableforge.names import columns_of
from tableforge.sources.catalog import raw_columns


def retail_schemas() -> dict[str, list[tuple[str, str]]]:
    """The 22 typed tables, as ``FIXTURES.md`` lists them."""
    listing = (ROOT / "FIXTURES.md").read_text(encoding="utf-8").split("\n## ")[1]
    tables = {}
    for block in listing.split("\n### ")[1:]:
        name, _, text = block.partition("\n")
        found = re.findall(r"`(\w+) ([A-Z]+(?:\(\d+,\d+\))?)`", text)
        tables[name.strip()] = [(column, kind.lower()) for column, kind in found]
    return tables


def text_in_raw() -> set[str]:
    listing = (ROOT / "FIXTURES.md").read_text(encoding="utf-8").split("\n## ")[1]
    return set(re.findall(r"`(\w+) [A-Z]+` \(raw STRING\)", listing))


def test_both_kinds_of_all_tables(spark, folder):
    schemas = retail_schemas()
    assert len(schemas) == 22 and sum(map(len, schemas.values())) == 372
    declare_database(spark, "raw", "retail_raw", schemas, f"{folder}/text")
    declare_database(spark, "typed", "retail_typed", schemas, f"{folder}/parquet")
    assert list_datasets(spark, "retail_raw") == sorted(schemas)
    assert list_datasets(spark, "retail_typed") == sorted(schemas)
    differing = set()
    for name, schema in schemas.items():
        raw = describe_table(spark, f"retail_raw.{name}")
        typed = describe_table(spark, f"retail_typed.{name}")
        assert raw.is_text and raw.text_format.sep == "|" and raw.text_format.quote == ""
        assert typed.provider == "parquet" and list(typed.columns) == schema
        differing |= {r[0] for r, t in zip(raw.columns, typed.columns) if r != t}
        assert {t for c, t in raw.columns if c in differing} <= {"string"}
    assert differing == text_in_raw() and len(differing) == 11


def test_all_tables_convert(spark, folder):
    """One made-up line per table, every column set, from text to typed Parquet."""
    schemas = retail_schemas()
    sample = {"date": "2001-02-03", "timestamp": "04:05:06", "string": "text"}
    for name, schema in schemas.items():
        line = "|".join(sample.get(kind, "7.5" if "decimal" in kind else "7") for _, kind in schema)
        write_lines(f"{folder}/text/{name}", [line + "|"])
    declare_database(spark, "raw", "retail_text", schemas, f"{folder}/text")
    declare_database(spark, "typed", "retail_parquet", schemas, f"{folder}/parquet")
    report = convert_database(
        spark, "retail_text", "retail_parquet", f"{folder}/text", f"{folder}/parquet"
    )
    assert sorted(values(report)) == [(name, 1) for name in sorted(schemas)]
    for name, schema in schemas.items():
        row = spark.table(f"retail_parquet.{name}").first()
        assert None not in tuple(row), name
    dates = spark.sql("SELECT CAST(dv_create_date AS STRING), CAST(dv_create_time AS STRING) "
                      "FROM retail_parquet.dbgen_version")
    assert values(dates) == [("2001-02-03", "1970-01-01 04:05:06")]


def test_raw_columns_follow_from_typed_ones():
    assert raw_columns([("a", "date"), ("b", "timestamp"), ("c", "int")]) == [
        ("a", "string"),
        ("b", "string"),
        ("c", "int"),
    ]


def test_schema_forms(spark):
    expected = [("a", "int"), ("b", "decimal(7,2)")]
    assert columns_of("a INT, b DECIMAL(7,2)") == expected
    assert columns_of(spark.createDataFrame([], "a int, b decimal(7,2)").schema) == expected
    assert columns_of(expected) == expected


def test_declaring_twice_keeps_the_first(spark, folder, database):
    declare_text_table(spark, f"{database}.t", "a INT", folder)
    declare_text_table(spark, f"{database}.t", "b STRING", folder)
    assert describe_table(spark, f"{database}.t").columns == (("a", "int"),)


def test_dropping_keeps_the_files(spark, folder, database):
    spark.range(2).write.parquet(f"{folder}/p")
    declare_parquet_table(spark, f"{database}.p", "id BIGINT", f"{folder}/p")
    drop_table(spark, f"{database}.p")
    drop_table(spark, f"{database}.p")
    assert describe_table(spark, f"{database}.p") is None
    assert spark.read.parquet(f"{folder}/p").count() == 2


def test_names_and_paths_with_odd_characters(spark, folder, database):
    path = f"{folder}/it's here"
    declare_text_table(spark, f"{database}.t", [("order", "int"), ("a b", "string")], path)
    write_lines(path, ["1|x"])
    assert values(spark.table(f"{database}.t")) == [(1, "x")]


def test_raw_table_properties(spark, folder, database):
    declare_text_table(spark, f"{database}.t", "a INT", folder)
    assert ("classification", "csv") in values(spark.sql(f"SHOW TBLPROPERTIES {database}.t"))


def test_views_are_no_datasets(spark, folder, database):
    declare_text_table(spark, f"{database}.b", "a INT", folder)
    declare_text_table(spark, f"{database}.a", "a INT", folder)
    spark.sql(f"CREATE VIEW {database}.v AS SELECT 1 AS a")
    spark.range(1).createOrReplaceTempView("temporary_view")
    assert list_datasets(spark, database) == ["a", "b"]


def test_default_database(spark, database):
    before = spark.catalog.currentDatabase()
    with use_database(spark, database):
        assert spark.catalog.currentDatabase() == database
    with pytest.raises(KeyError), use_database(spark, database):
        raise KeyError
    assert spark.catalog.currentDatabase() == before
    with use_database(spark, None):
        assert spark.catalog.currentDatabase() == before


def test_partitions_of_declared_tables(spark, folder, database):
    spark.sql("SELECT 1 AS a, 'x' AS k").write.partitionBy("k").parquet(f"{folder}/p")
    declare_parquet_table(spark, f"{database}.p", "a INT, k STRING", f"{folder}/p", ["k"])
    entry = describe_table(spark, f"{database}.p")
    assert entry.partition_columns == ("k",)
    spark.catalog.recoverPartitions(f"{database}.p")
    assert values(spark.table(f"{database}.p")) == [(1, "x")]


def test_kind_is_checked(spark, folder):
    with pytest.raises(ValueError, match="kind"):
        declare_database(spark, "orc", "nowhere", {}, folder)


def test_looking_up_a_table_lists_no_files(spark, folder, database):
    declare_parquet_table(spark, f"{database}.gone", "a INT", f"{folder}/never/written")
    assert describe_table(spark, f"{database}.gone").columns == (("a", "int"),)
    assert not Path(f"{folder}/never").exists()
