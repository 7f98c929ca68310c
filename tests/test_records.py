"""Records that span lines, gathered from splits, against Spark's reader of whole files."""

from __future__ import annotations

import random

import pytest
from conftest import SMALL, values

from tableforge import TextFormat, scan_text
from tableforge.sources.records import numbered_lines, records

NAMES = ["a", "b", "c"]
BACKSLASH, DOUBLED = {"sep": "|"}, {"sep": ",", "escape": '"'}


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def rows(spark, path, form, split, names=NAMES, **kwargs):
    found = scan_text(spark, path, TextFormat(multi_line=True, split_records=split, **form), names, **kwargs)
    return sorted(values(found), key=str)


@pytest.mark.parametrize("form", [BACKSLASH, DOUBLED])
def test_whole_documents(spark, folder, small_splits, form):
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr(
        "doc_id", "concat(chr(34), text, chr(10), chr(10), 'x', chr(34)) AS text", "source"
    )
    texts.where("length(text) < 3000").coalesce(2).write.options(**TextFormat(**form).options()).csv(f"{folder}/t")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    assert numbered_lines(spark, f"{folder}/t").rdd.getNumPartitions() > 20
    expected = rows(spark, f"{folder}/t", form, False)
    assert rows(spark, f"{folder}/t", form, True) == expected and len(expected) > 100


@pytest.mark.parametrize("form", [BACKSLASH, DOUBLED])
@pytest.mark.parametrize("uneven", [False, True])
def test_odd_values(spark, folder, small_splits, form, uneven):
    """Values of quotes, escapes, separators and line breaks, in splits of a few lines."""
    rng, fmt = random.Random(5), TextFormat(**form)
    for name in ("one", "two"):
        with open(f"{folder}/{name}.txt", "w", encoding="utf-8", newline="") as file:
            for k in range(150):
                row = [str(k)]
                for _ in range(rng.choice([1, 2, 2, 2, 3])):
                    inner = "".join(rng.choice(["é", "x", "\n", "\n\n", fmt.sep, '"', " y "]) for _ in range(rng.randrange(9)))
                    quoted = '"' + inner.replace('"', fmt.escape + '"') + '"'
                    row.append(quoted if rng.random() < 0.7 else rng.choice(["", "plain", "p q"]))
                file.write(fmt.sep.join(row) + rng.choice(["\n", "\n", "\n\n"]))
    expected = rows(spark, folder, form, False, uneven=uneven)
    assert rows(spark, folder, form, True, uneven=uneven) == expected and len(expected) == 300


def test_headers(spark, folder, small_splits):
    form = {"sep": "|", "header": True}
    for name in ("one", "two"):
        with open(f"{folder}/{name}.txt", "w") as file:
            file.write('a|b|c\n' + "".join(f'{k}|"x\ny|{k}"|z\n' for k in range(60)))
    expected = rows(spark, folder, form, False, None)
    assert rows(spark, folder, form, True, None) == expected == rows(spark, folder, form, True) and len(expected) == 120
    with open(f"{folder}/three.txt", "w") as file:
        file.write("a|d|c\n1|2|3\n")
    with pytest.raises(Exception, match="another header"):
        rows(spark, folder, form, True, None)


def test_lines_of_other_systems_and_open_ends(spark, folder, small_splits):
    with open(f"{folder}/t.txt", "w", newline="") as file:
        file.write("".join(f'{k}|"x\n|{k}"|z\r\n' for k in range(99)) + '99|"open\nto the end|')
    found = rows(spark, folder, BACKSLASH, True)
    assert found == sorted([(str(k), f"x\n|{k}", "z") for k in range(99)] + [("99", "open\nto the end|", None)], key=str)
    assert values(scan_text(spark, f"{folder}/t.txt", TextFormat("|", multi_line=True, split_records=True), NAMES).where("false")) == []


def test_records_longer_than_blocks(spark, folder, small_splits):
    with open(f"{folder}/t.txt", "w") as file:
        file.write('1|"' + "line\n" * 500 + '"|z\n2|"a"|b\n3|"' + "x" * 2000 + "\n" * 700 + '"|"\n"\n')
    found = values(records(numbered_lines(spark, f"{folder}/t.txt"), TextFormat(sep="|")).orderBy("block", "record").select("text"))
    assert [len(text) for (text,) in found] == [2 + 1 + 2500 + 3, 7, 2 + 1 + 2700 + 5]
    assert rows(spark, folder, BACKSLASH, True) == rows(spark, folder, BACKSLASH, False)
