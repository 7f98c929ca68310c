from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from conftest import plan_of, values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableforge import cast_to_columns
from tableforge.session import ANSI_MODE, bad_casts_give_null

TEXT_CASES = [
    ("int", "12", 12),
    ("int", "12.7", 12),
    ("int", "-12.7", -12),
    ("int", " 12 ", 12),
    ("int", "007", 7),
    ("int", "+7", 7),
    ("int", "5.", 5),
    ("int", "", None),
    ("int", None, None),
    ("int", "3000000000", None),
    ("int", "-2147483648", -2147483648),
    ("int", "2147483648", None),
    ("int", "abc", None),
    ("int", "1e2", None),
    ("int", "1,000", None),
    ("int", "12.7.1", None),
    ("int", "0.9999999", 0),
    ("int", ".5", 0),
    ("int", "-.9", 0),
    ("int", ".", None),
    ("int", "-.", None),
    ("int", "-", None),
    ("INTEGER", "12.7", 12),
    ("bigint", "3000000000.9", 3000000000),
    ("Long", "9223372036854775807", 9223372036854775807),
    ("bigint", "9223372036854775808", None),
    ("bigint", ".", None),
    ("double", "1e3", 1000.0),
    ("double", "abc", None),
    ("float", " 2.5 ", 2.5),
    ("decimal", "2.5", 2.5),
    ("decimal(5,2)", "1.5", Decimal("1.50")),
    ("decimal(5,2)", "12345.67", None),
    ("DECIMAL(7,2)", "abc", None),
    ("date", "2024-01-01", datetime.date(2024, 1, 1)),
    ("date", "2024-1-5", None),
    ("date", "2024-02-30", None),
    ("date", "bad", None),
    ("timestamp", "12:34:56", datetime.datetime(1970, 1, 1, 12, 34, 56)),
    ("timestamp with time zone", "00:00:01", datetime.datetime(1970, 1, 1, 0, 0, 1)),
    ("timestamp", "2024-01-01 10:00:00", None),
    ("timestamp", "24:00:00", None),
    ("string", " as is ", " as is "),
    ("boolean", "true", "true"),
    ("varchar(3)", "abcdef", "abcdef"),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_under_each_type(spark, ansi):
    before = spark.conf.get(ANSI_MODE)
    names = [f"c{i}" for i in range(len(TEXT_CASES))]
    schema = ", ".join(f"{name} string" for name in names)
    rows = spark.createDataFrame([tuple(text for _, text, _ in TEXT_CASES)], schema)
    spark.conf.set(ANSI_MODE, ansi)
    try:
        typed = cast_to_columns(rows, [(n, t) for n, (t, _, _) in zip(names, TEXT_CASES)])
        typed = typed.select(
            *(
                F.col(n).cast("timestamp_ntz") if t == "timestamp" else F.col(n)
                for n, t in typed.dtypes
            )
        )
        got = typed.first()
    finally:
        spark.conf.set(ANSI_MODE, before)
    wrong = {
        (kind, text): (value, expected)
        for (kind, text, expected), value in zip(TEXT_CASES, got)
        if value != expected
    }
    assert not wrong


def test_types_of_the_result(spark):
    names = ["date", "timestamp", "int", "long", "float", "decimal", "decimal(7,2)", "char(2)"]
    rows = spark.createDataFrame([("x",) * 8], ", ".join(f"c{i} string" for i in range(8)))
    typed = cast_to_columns(rows, [(f"c{i}", name) for i, name in enumerate(names)])
    assert [t for _, t in typed.dtypes] == [
        "date",
        "timestamp",
        "int",
        "bigint",
        "double",
        "double",
        "decimal(7,2)",
        "string",
    ]


def test_columns_are_matched_by_exact_name_and_keep_their_order(spark):
    rows = spark.createDataFrame([("1", "2", "3", "4")], "b string, A string, extra string, `x.y` string")
    typed = cast_to_columns(rows, [("absent", "int"), ("a", "int"), ("x.y", "int"), ("b", "int")])
    assert typed.dtypes == [("b", "int"), ("A", "string"), ("extra", "string"), ("x.y", "int")]
    assert values(typed) == [(1, "2", "3", 4)]


def test_columns_that_are_no_text(spark):
    rows = spark.sql(
        "SELECT DATE'2024-01-02' AS d, TIMESTAMP'2024-01-02 03:04:05' AS t, 12.7D AS x, "
        "3000000000L AS big, 5 AS same, DATE'2024-01-02' AS dt, "
        "TIMESTAMP'2024-01-02 03:04:05' AS td"
    )
    typed = cast_to_columns(
        rows,
        [
            ("d", "date"),
            ("t", "timestamp"),
            ("x", "int"),
            ("big", "int"),
            ("same", "int"),
            ("dt", "timestamp"),
            ("td", "date"),
        ],
    )
    got = typed.select(F.col("d"), F.col("t").cast("string"), "x", "big", "same", "td").first()
    day = datetime.date(2024, 1, 2)
    assert tuple(got) == (day, "2024-01-02 03:04:05", 12, None, 5, day)


def test_one_projection_without_python(spark):
    rows = spark.range(3).select(*(F.col("id").cast("string").alias(f"c{i}") for i in range(20)))
    plan = plan_of(cast_to_columns(rows, [(f"c{i}", "int") for i in range(20)]), "simple")
    assert plan.count("Project") == 2  # one makes the rows
    assert "Python" not in plan


def test_formats_are_parameters(spark):
    rows = spark.createDataFrame([("05/01/2024", "2024-01-05 06:07:08")], "d string, t string")
    typed = cast_to_columns(
        rows, [("d", "date"), ("t", "timestamp")], "dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss"
    )
    got = typed.select("d", F.col("t").cast("string")).first()
    assert tuple(got) == (datetime.date(2024, 1, 5), "2024-01-05 06:07:08")


def test_the_session_mode_comes_back(spark):
    before = spark.conf.get(ANSI_MODE)
    with pytest.raises(KeyError), bad_casts_give_null(spark):
        assert spark.conf.get(ANSI_MODE) == "false"
        raise KeyError
    assert spark.conf.get(ANSI_MODE) == before


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(alphabet=" 0123456789+-.eE,a\t", max_size=12), min_size=40, max_size=40, unique=True
    )
)
def test_whole_numbers_against_the_rule(spark, texts):
    import re

    def expected(text: str, low: int, high: int) -> int | None:
        match = re.fullmatch(r"\s*([+-]?)([0-9]*)(\.[0-9]*)?\s*", text)
        if match is None or not re.search("[0-9]", text):
            return None
        number = int((match[1] if match[2] else "") + (match[2] or "0"))
        return number if low <= number <= high else None

    rows = spark.createDataFrame([(t, t, t) for t in texts], "text string, i string, l string")
    typed = cast_to_columns(rows, [("i", "int"), ("l", "bigint")])
    for text, i, l in values(typed):
        assert i == expected(text, -(2**31), 2**31 - 1), text
        assert l == expected(text, -(2**63), 2**63 - 1), text


def test_declared_types_are_exact(spark):
    """Text ends in the type of the table, so that the table can be read."""
    kinds = {
        "float": ("2.5", 2.5), "smallint": ("300.9", 300), "tinyint": ("300", None), "boolean": ("true", True),
        "double": ("x", None), "varchar(3)": ("abc", "abc"), "binary": ("a", bytearray(b"a")),
        "timestamp_ntz": ("01:02:03", datetime.datetime(1970, 1, 1, 1, 2, 3)),
    }
    schema = ", ".join(f"c{k} string" for k in range(len(kinds)))
    rows = spark.createDataFrame([tuple(text for text, _ in kinds.values())], schema)
    target = [(f"c{k}", kind) for k, kind in enumerate(kinds)]
    typed = cast_to_columns(rows, target, declared=True)
    assert [t for _, t in typed.dtypes] == [k if k != "varchar(3)" else "string" for k in kinds]
    assert values(typed) == [tuple(value for _, value in kinds.values())]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.dates().map(str),
            st.text(alphabet=" 0123456789+-T:", min_size=8, max_size=12),
            st.from_regex(r"[ +-]?[0-9]{3,5}-[ 0-9]{1,2}-[ 0-9T]{1,3}", fullmatch=True),
        ),
        min_size=40,
        max_size=40,
    )
)
def test_dates_against_the_pattern_parser(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    typed = cast_to_columns(rows, [("text", "date")])
    expected = rows.select(F.try_to_date("text", "yyyy-MM-dd").cast("string"))
    assert values(typed.select(F.col("text").cast("string"))) == values(expected)


NO_NUMBERS = ("x", "1,5", "1.5.1", ".", "", " ", "e5", "1e", "0x", "nano", "+-1", "1 2", "1_0", "١", "-", "1.5 d")
NUMBERS = (
    "1", " 1.5\t", "+.5", "-5.", "1e5", "1E-5", "1.5d", "2F", "nan", "NaN", " INF ", "-Infinity", "+inf", "-inf",
    "infinity", "0x1.8p1", "-0X1P3f", "1e400", "\x011.5\x00", "00.10", "1.D", ".5e+3f",
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.sampled_from(NUMBERS + NO_NUMBERS),
            st.floats().map(str),
            st.integers(-70000, 70000).map(str),
            st.text(alphabet=" 0123456789+-.eEdDfFxXpPnNaAiI\t\n", max_size=8),
            st.times().map(str),
            st.text(alphabet="0123:", min_size=7, max_size=9),
            st.sampled_from(["true", " T ", "yes", "N", "0", "off", "23:59:59\n", " 01:02:03", "24:00:00"]),
        ),
        min_size=40,
        max_size=40,
    )
)
def test_checked_texts_against_tried_casts(spark, texts):
    """Checks before a cast change the price of a misfit and no value."""
    rows = spark.createDataFrame([(t,) for t in list(NUMBERS + NO_NUMBERS) + texts], "text string")
    kinds = ["double", "float", "smallint", "tinyint", "boolean", "timestamp"]
    copies = rows.select(*(F.col("text").alias(kind) for kind in kinds))
    typed = cast_to_columns(copies, [(kind, kind) for kind in kinds], declared=True)
    text = F.col("text")
    whole = cast_to_columns(rows.select(text, text.alias("whole")), [("whole", "int")])
    tried = [
        text.try_cast("double"),
        text.try_cast("double").cast("float"),
        F.col("whole").try_cast("smallint"),
        F.col("whole").try_cast("tinyint"),
        text.try_cast("boolean"),
        F.try_to_timestamp(text, F.lit("HH:mm:ss")),
    ]
    expected = whole.select(*(value.cast("string") for value in tried))
    assert values(typed.select(*(F.col(kind).cast("string") for kind in kinds))) == values(expected)


def test_misfits_cost_no_exception(spark):
    """Nothing is tried that raises inside for each misfit: the checks come first."""
    kinds = ["double", "float", "smallint", "tinyint", "boolean", "timestamp"]
    rows = spark.range(3).select(*(F.col("id").cast("string").alias(kind) for kind in kinds))
    plan = plan_of(cast_to_columns(rows, [(kind, kind) for kind in kinds], declared=True), "extended").lower()
    assert "gettimestamp" not in plan and "try_to_timestamp" not in plan
    assert not any(f"try_cast({name}" in plan for name in ("boolean", "cast(", "case "))
    # Numbers are read where the text has passed a check.
    assert plan.count("case when rlike(double") > 0 and plan.count("case when rlike(float") > 0
