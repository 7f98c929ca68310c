"""Supplied tables, and the delimited text that Spark derives from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from tableforge.sources.text import RAW_TABLE_FORMAT, TextFormat
from tableforge.workspace import new_folder

# Columns of supplied tables as text files carry them.
TEXT_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, "
    "c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, "
    "p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice decimal(15,2), o_orderdate date, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity decimal(15,2), l_extendedprice decimal(15,2), l_discount decimal(5,2), "
    "l_tax decimal(5,2), l_returnflag string, l_linestatus string, l_shipdate date",
}

#: Options of text that is staged to be read back: as plain text it is the most that a conversion
#: moves. One task reads a compressed file, so files are bounded by rows.
COMPRESSED = {
    "compression": "gzip",
    "zlib.compress.level": "BEST_SPEED",
    "maxRecordsPerFile": 100_000,
}

_staged: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text; time stamps of day precision as dates."""
    return df.select(
        *(
            F.col(f.name).cast("date").cast("string").alias(f.name)
            if isinstance(f.dataType, (TimestampType, TimestampNTZType))
            else F.col(f.name).cast("string")
            for f in df.schema.fields
        )
    )


def write_text(
    df: DataFrame,
    path: str,
    text_format: TextFormat = RAW_TABLE_FORMAT,
    mode: str = "append",
    **options: str | int,
) -> None:
    df.write.mode(mode).options(
        **text_format.options(),
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        **options,
    ).csv(path)


def staged(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Folder that ``write`` filled, once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _staged:
        folder = new_folder(spark, f"text-{label}")
        write(folder)
        _staged[key] = folder
    return _staged[key]


def staged_tables(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """The text tables, ``|``-delimited, one folder each: ``names`` are there, or all of them."""
    base = staged(spark, sf_dir, "tables", lambda folder: None)
    for name in names or TEXT_TABLES:
        key = (spark.sparkContext.applicationId, sf_dir, f"tables/{name}")
        if key not in _staged:
            write_text(as_text(table(spark, sf_dir, name)), f"{base}/{name}", **COMPRESSED)
            _staged[key] = f"{base}/{name}"
    return base


def staged_table(
    spark: SparkSession,
    sf_dir: str,
    label: str,
    rows: DataFrame,
    text_format: TextFormat,
    **options: str | int,
) -> str:
    """Folder with ``rows`` as the text of a dataset named ``label``."""

    def write(folder: str) -> None:
        write_text(rows, f"{folder}/{label}", text_format, **options)

    return staged(spark, sf_dir, label, write)


def new_database(spark: SparkSession, label: str) -> str:
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    location = new_folder(spark, f"db-{label}")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    return name


TYPED = (DateType, DecimalType, TimestampType, TimestampNTZType)


def comparable(df: DataFrame) -> DataFrame:
    """Dates, times and decimals as text, which both engines print alike, and their types.

    The column ``types`` lists the types these columns had, so that a missing cast shows.
    """
    typed = [f.name for f in df.schema.fields if isinstance(f.dataType, TYPED)]
    types = [F.concat(F.lit(f"{name} "), F.typeof(name)) for name in sorted(typed)]
    columns = [F.col(n).cast("string").alias(n) if n in typed else F.col(n) for n in df.columns]
    return df.select(*columns, F.concat_ws(", ", *types).alias("types"))


def file_names(spark: SparkSession, path: str) -> DataFrame:
    """Paths of the files below a folder, a row each; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where(F.col("path").endswith(".parquet")).select(F.col("path").alias("file_name"))
