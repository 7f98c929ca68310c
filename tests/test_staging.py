"""Text that the queries derive from the supplied tables."""

from __future__ import annotations

from pathlib import Path

from conftest import SMALL, values

from workload import conversions, staging


def files_of(folder: str) -> list[Path]:
    return [file for file in Path(folder).rglob("part-*") if file.is_file()]


def test_derived_text_is_compressed_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(staging, "_staged", {})
    monkeypatch.setitem(conversions.COMPRESSED, "maxRecordsPerFile", 1000)
    texts = {**conversions.NUMBER_KEY, **conversions.NUMBER_TEXTS}
    base = conversions.derived_text(spark, SMALL, "bounded", "lineitem", texts)
    files = files_of(base)
    rows = staging.table(spark, SMALL, "lineitem").selectExpr(
        *(f"CAST({sql} AS STRING) AS {name}" for name, sql in texts.items())
    )
    lines = spark.read.text(f"{base}/bounded")
    assert {file.suffix for file in files} == {".gz"}
    assert len(files) >= rows.count() / 1000
    assert sum(file.stat().st_size for file in files) < sum(len(line) + 1 for (line,) in values(lines)) / 2
    assert sorted(line for (line,) in values(lines)) == sorted("|".join(row) for row in values(rows))


def test_a_query_stages_the_tables_it_converts(spark, monkeypatch):
    monkeypatch.setattr(staging, "_staged", {})
    conversions.convert_headerless(spark, SMALL)
    base = Path(staging.staged_tables(spark, SMALL, "customer"))
    assert [folder.name for folder in base.iterdir()] == ["customer"]
    first = files_of(str(base))
    assert Path(staging.staged_tables(spark, SMALL, "customer", "nation")) == base
    assert sorted(folder.name for folder in base.iterdir()) == ["customer", "nation"]
    assert set(first) <= set(files_of(str(base)))
    assert {file.suffix for file in files_of(str(base))} == {".gz"}
    assert len(files_of(f"{base}/customer")) == len(first)
