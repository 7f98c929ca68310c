"""Values beyond the columns: by the reader's own rules, and in linear time."""

from __future__ import annotations

import random
import time

import pytest
from conftest import write_lines
from pyspark.sql import functions as F

from tableforge import ConversionOptions, ExtraValues, TextFormat, convert_dataset
from tableforge.sources.text import values_beyond

FORMATS = [
    TextFormat(),
    TextFormat(sep="|", quote=""),
    TextFormat(sep=";", escape='"'),
    TextFormat(sep="||", quote="'"),
    TextFormat(sep="\t", quote='"', escape="^"),
]


def beyond(spark, lines, width, text_format):
    frame = spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "k int, line string")
    rows = frame.select("k", values_beyond(F.col("line"), width, text_format).alias("v")).collect()
    return [row.v for row in sorted(rows)]


@pytest.mark.parametrize("text_format", FORMATS, ids=lambda f: f"{f.sep}{f.quote}{f.escape}")
def test_values_are_those_of_the_reader(spark, folder, text_format):
    pick = random.Random(5)
    quote, escape = text_format.quote, text_format.escape

    def value():
        text = "".join(pick.choice(["a", "b", "é", "1", ".", "a b"]) for _ in range(pick.randrange(1, 4)))
        if not quote or pick.random() < 0.4:
            return text if pick.random() < 0.9 else ""
        marks = [text_format.sep, escape + quote, "x", escape + escape if escape != quote else "y"]
        inside = "".join(pick.choice(marks) for _ in range(pick.randrange(0, 5)))
        return quote + text + inside + quote

    lines = ["k" + text_format.sep + text_format.sep.join(value() for _ in range(pick.randrange(1, 8))) for _ in range(400)]
    path = write_lines(f"{folder}/lines", lines)
    names = [f"c{k}" for k in range(9)]
    schema = ", ".join(f"{name} string" for name in names)
    read = spark.read.schema(schema).options(**text_format.options()).csv(path)
    expected = sorted(tuple(v for v in row[3:] if v and v.strip()) for row in read.collect())
    got = beyond(spark, lines, 3, text_format)

    # The reader takes escapes away, and the list keeps them.
    def bare(text):
        return text.replace(quote, "").replace(escape, "") if quote else text

    assert sorted(tuple(map(bare, values)) for values in got) == sorted(tuple(map(bare, v)) for v in expected)


def test_broken_quotes_lose_nothing(spark):
    lines = ['a,b,"open,c', 'a,b,"x"y,z', 'a,b,c,"', 'a,b,"c""d",e', "a,b", "", 'a,"b,c"', 'a,"b\\"', "a,b,,,"]
    assert beyond(spark, lines, 2, TextFormat()) == [
        ['"open', "c"], ['"x"y', "z"], ["c", '"'], ['c""d', "e"], [], [], [], [], [],
    ]


@pytest.mark.parametrize("marks", [20_000, 200_000])
@pytest.mark.parametrize("inside", [",", '\\",', "\\\\,"])
def test_long_quoted_values_take_linear_time(spark, marks, inside):
    lines = [f'a,"{inside * marks}"', f'a,"{inside * marks}",c', f'a,b,c,"{inside * marks}"', f'a,"{inside * marks}']
    beyond(spark, lines[:1], 2, TextFormat())
    started = time.perf_counter()
    got = beyond(spark, lines, 2, TextFormat())
    assert time.perf_counter() - started < 10
    assert got[0] == [] and got[1] == ["c"] and got[2] == ["c", inside * marks]


def test_a_long_uneven_row_converts_soon(spark, folder):
    text = "word, " * 20_000
    write_lines(f"{folder}/in/notes", [f'1,"{text}"', f'2,"{text}",more', "3,short"])
    target = [("id", "int"), ("note", "string")]

    def convert(rule, out):
        options = ConversionOptions(text_format=TextFormat(), extra_values=rule)
        started = time.perf_counter()
        done = convert_dataset(spark, "notes", f"{folder}/in", f"{folder}/{out}", target=target, options=options)
        return done, time.perf_counter() - started

    convert("ignore", "warm")
    _, plain = convert("ignore", "plain")
    done, kept = convert("keep", "kept")
    assert kept < plain + 3
    rows = {row.id: (row.note, row.extra_values) for row in done.frame.collect()}
    assert rows == {1: (text, None), 2: (text, ["more"]), 3: ("short", None)}
    with pytest.raises(ExtraValues) as error:
        convert("error", "none")
    assert error.value.rows == 1
