"""Declared tables, whole databases, and files that arrive later."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge import (
    BatchOptions,
    ConversionFailed,
    ConversionOptions,
    ExtraValues,
    convert_changed_files,
    convert_database,
    convert_dataset,
    convert_new_files,
    declare_database,
    declare_parquet_table,
    declare_text_table,
    drop_table,
    run_batch,
    use_database,
)
from tableforge.names import columns_of
from tableforge.sources.catalog import raw_columns
from tableforge.workspace import new_folder
from workload.conversions import PLAIN
from workload.staging import (
    TEXT_TABLES,
    as_text,
    comparable,
    new_database,
    staged_tables,
    table,
    write_text,
)

BY_FLAG = {"lineitem": ["l_returnflag"]}


def external_text_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declare, drop and declare again: the files of an external table stay."""
    location = f"{staged_tables(spark, sf_dir, 'orders')}/orders"
    database = new_database(spark, "text")
    columns = raw_columns(TEXT_TABLES["orders"])
    for _ in range(2):
        declare_text_table(spark, f"{database}.orders", columns, location)
        drop_table(spark, f"{database}.orders")
    declare_text_table(spark, f"{database}.orders", columns, location)
    with use_database(spark, database):
        rows = spark.sql("SELECT * FROM orders WHERE o_orderdate >= '1997-01-01'")
    return comparable(rows)


def external_parquet_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = new_database(spark, "parquet")
    schema = table(spark, sf_dir, "orders").schema
    declare_parquet_table(spark, f"{database}.orders", schema, f"{sf_dir}/orders.parquet")
    with use_database(spark, database):
        rows = spark.sql("SELECT * FROM orders WHERE o_orderstatus = 'F'")
    return comparable(rows)


def _converted_pair(spark: SparkSession, sf_dir: str, **kwargs) -> tuple[str, DataFrame]:
    """Declare raw and typed tables, convert all; returns typed database and report."""
    base, out = staged_tables(spark, sf_dir), new_folder(spark, "parquet")
    raw, typed = new_database(spark, "raw"), new_database(spark, "typed")
    declare_database(spark, "raw", raw, TEXT_TABLES, base)
    declare_database(spark, "typed", typed, TEXT_TABLES, out, partition_by=BY_FLAG)
    return typed, convert_database(spark, raw, typed, base, out, partition_keys=BY_FLAG, **kwargs)


def convert_whole_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted_pair(spark, sf_dir)[1]


def convert_database_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four datasets side by side: the report, and the rows that this session sees."""
    typed, report = _converted_pair(spark, sf_dir, at_once=4)
    seen = [
        spark.table(f"{typed}.{name}").agg(F.count(F.lit(1))).select(F.lit(f"rows of {name}"), "*")
        for name in TEXT_TABLES
    ]
    return reduce(DataFrame.union, seen, report)


def convert_whole_database_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report by names of the typed database, after declare and convert."""
    typed, _ = _converted_pair(spark, sf_dir)
    with use_database(spark, typed):
        return spark.sql(
            """
            SELECT l_returnflag, l_shipdate, count(*) AS line_count,
                   CAST(sum(l_extendedprice) AS STRING) AS total_price
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            WHERE o_orderstatus = 'F' AND l_returnflag = 'R'
            GROUP BY l_returnflag, l_shipdate
            """
        ).transform(comparable)


def convert_listed_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listed dataset without a raw table is read as plain text."""
    base, out = staged_tables(spark, sf_dir, "orders", "part"), new_folder(spark, "parquet")
    raw, typed = new_database(spark, "raw"), new_database(spark, "typed")
    declare_database(spark, "raw", raw, {"orders": TEXT_TABLES["orders"]}, base)
    declare_database(spark, "typed", typed, {"part": TEXT_TABLES["part"]}, out)
    options = ConversionOptions(text_format=PLAIN)
    names = ["orders", "part"]
    report = convert_database(spark, raw, typed, base, out, datasets=names, options=options)
    part = spark.table(f"{typed}.part").agg(
        F.lit("part price cents").alias("dataset"),
        F.sum(F.round(F.col("p_retailprice") * 100).cast("bigint")).alias("rows_read"),
    )
    return report.unionByName(part)


def insert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT of a query and of literal rows, with the number of rows inserted."""
    database = new_database(spark, "inserts")
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_to_insert")
    report = run_batch(
        spark,
        [
            "CREATE TABLE totals (priority STRING, order_count BIGINT) USING parquet",
            "INSERT INTO totals SELECT o_orderpriority, count(*) FROM orders_to_insert "
            "GROUP BY o_orderpriority",
            "INSERT INTO totals (order_count, priority) VALUES (0, 'none'), (-1, NULL)",
        ],
        options=BatchOptions(database=database),
    )
    counts = report.filter(F.col("row_count").isNotNull()).select(
        F.concat(F.lit("inserted by "), F.col("statement_no")).alias("priority"),
        F.col("row_count").alias("order_count"),
    )
    return spark.table(f"{database}.totals").unionByName(counts)


def _two_arrivals(spark: SparkSession, sf_dir: str, **kwargs) -> tuple[DataFrame, list[int]]:
    """Convert after a first, a second and no further arrival of order files."""
    landing, out, log = (new_folder(spark, name) for name in ("landing", "parquet", "log"))
    raw = new_database(spark, "raw")
    declare_database(spark, "raw", raw, {"orders": TEXT_TABLES["orders"]}, landing)
    orders = as_text(table(spark, sf_dir, "orders"))
    finished = F.col("o_orderstatus").eqNullSafe("F")
    counts = []
    for arrival in (orders.filter(finished), orders.filter(~finished), None):
        if arrival is not None:
            write_text(arrival, f"{landing}/orders", PLAIN)
        run = convert_new_files(
            spark,
            "orders",
            landing,
            out,
            log,
            source_db=raw,
            target=columns_of(TEXT_TABLES["orders"]),
            **kwargs,
        )
        counts.append(run.rows_read)
    schema = ", ".join(f"{n} {t}" for n, t in columns_of(TEXT_TABLES["orders"]))
    return spark.read.schema(schema).parquet(f"{out}/orders"), counts


def convert_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_two_arrivals(spark, sf_dir)[0])


def convert_incremental_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, counts = _two_arrivals(spark, sf_dir, partition_keys="o_orderstatus")
    total = rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("order_count"))
    return total.select(
        "*", *(F.lit(n).cast("bigint").alias(f"run_{i}") for i, n in enumerate(counts, start=1))
    )


def _declared_twice(spark: SparkSession, sf_dir: str, keys: list[str]) -> DataFrame:
    """Rows of a declared table after two incremental runs, the table read in between."""
    raw, typed, label = new_database(spark, "raw"), new_database(spark, "typed"), "orders"
    landing, out, log = (new_folder(spark, name) for name in ("landing", "declared", "log"))
    schemas = {label: TEXT_TABLES[label]}
    declare_database(spark, "raw", raw, schemas, landing)
    declare_database(spark, "typed", typed, schemas, out, partition_by={label: keys})
    orders = as_text(table(spark, sf_dir, label))
    finished = F.col("o_orderstatus").eqNullSafe("F")
    seen = []
    for arrival in (orders.filter(finished), orders.filter(~finished), None):
        if arrival is not None:
            write_text(arrival, f"{landing}/{label}", PLAIN)
        convert_new_files(spark, label, landing, out, log, source_db=raw, target_db=typed)
        seen.append(spark.table(f"{typed}.{label}").count())
    names = [name for name, _ in columns_of(TEXT_TABLES[label])]
    rows = comparable(spark.table(f"{typed}.{label}").select(*names))
    return rows.select("*", *(F.lit(n).cast("bigint").alias(f"seen_{i}") for i, n in enumerate(seen, start=1)))


def convert_incremental_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _declared_twice(spark, sf_dir, [])


def convert_incremental_declared_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _declared_twice(spark, sf_dir, ["o_orderstatus", "o_orderpriority"])


def convert_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrivals in batches of three files; the second has a bad row and is written anew."""
    raw, typed, label = new_database(spark, "raw"), new_database(spark, "typed"), "orders"
    landing, out, ledger = (new_folder(spark, name) for name in ("landing", "changed", "ledger"))
    schemas = {label: TEXT_TABLES[label]}
    declare_database(spark, "raw", raw, schemas, landing)
    declare_database(spark, "typed", typed, schemas, out, partition_by={label: ["o_orderstatus"]})
    orders = as_text(table(spark, sf_dir, label)).repartition(5, "o_orderkey")
    run = partial(
        convert_changed_files, spark, label, landing, out, ledger, raw, typed, max_files_per_batch=3
    )
    counts = []
    for number, status in enumerate("FOP"):
        folder = f"{landing}/{label}/{number}"
        rows = orders.where(F.col("o_orderstatus") == status)
        write_text(rows, folder, PLAIN)
        if status == "O":
            too_wide = spark.createDataFrame([("9|9|O|1|1997-01-01|x|y|z",)], "value string")
            too_wide.write.mode("append").text(folder)
            try:
                run()
            except ExtraValues:
                # The files before the bad one may be converted, and are known then.
                write_text(rows.limit(0), folder, PLAIN, "overwrite")
                known = spark.table(f"{typed}.{label}").where("o_orderstatus = 'O'").select("o_orderkey")
                write_text(rows.join(known, "o_orderkey", "left_anti").select(*rows.columns), folder, PLAIN)
        run()
        counts.append(spark.table(f"{typed}.{label}").count())
    names = [name for name, _ in columns_of(TEXT_TABLES[label])]
    rows = comparable(spark.table(f"{typed}.{label}").select(*names))
    return rows.select("*", *(F.lit(n).cast("bigint").alias(f"seen_{n_}") for n_, n in enumerate(counts, start=1)))


def convert_replaced_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second conversion that brings one key again, with other rows; other keys stay."""
    raw, typed, label = new_database(spark, "raw"), new_database(spark, "typed"), "orders"
    first, second, out = (new_folder(spark, name) for name in ("first", "second", "replaced"))
    schemas = {label: TEXT_TABLES[label]}
    declare_database(spark, "raw", raw, schemas, first)
    declare_database(spark, "typed", typed, schemas, out, partition_by={label: ["o_orderstatus"]})
    orders = as_text(table(spark, sf_dir, label))
    write_text(orders, f"{first}/{label}", PLAIN)
    again = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit("1.00"))
    write_text(again.where("cast(o_orderkey as bigint) % 2 = 0"), f"{second}/{label}", PLAIN)
    options = ConversionOptions(mode="replace_partitions")
    for base in (first, second):
        convert_dataset(spark, label, base, out, source_db=raw, target_db=typed, options=options)
    return spark.table(f"{typed}.{label}").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("o_totalprice").cast("string").alias("total")
    )


def convert_database_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that fails in its third dataset and is repeated as it was, twice."""
    raw, typed = new_database(spark, "raw"), new_database(spark, "typed")
    text, out, ledger = (new_folder(spark, name) for name in ("text", "resumed", "ledger"))
    names = ["customer", "nation", "orders", "supplier"]
    schemas = {name: TEXT_TABLES[name] for name in names}
    declare_database(spark, "raw", raw, schemas, text)
    declare_database(spark, "typed", typed, schemas, out, partition_by={"customer": ["c_mktsegment"]})
    for name in names:
        write_text(as_text(table(spark, sf_dir, name)), f"{text}/{name}", PLAIN)
    too_wide = spark.createDataFrame([("9|9|F|1|1997-01-01|x|y|z",)], "value string")
    too_wide.write.mode("append").text(f"{text}/orders")
    run = partial(convert_database, spark, raw, typed, text, out, datasets=names, ledger_path=ledger)
    before = -1
    try:
        run()
    except ConversionFailed as failed:
        before = len(failed.report)
    write_text(as_text(table(spark, sf_dir, "orders")), f"{text}/orders", PLAIN, "overwrite")
    run()
    found = [run()]
    for name in names:
        found.append(spark.table(f"{typed}.{name}").agg(F.count(F.lit(1))).select(F.lit(f"rows of {name}"), "*"))
    return reduce(DataFrame.union, found).withColumn("done_before", F.lit(before))


QUERIES = {
    "external_text_table": external_text_table,
    "external_parquet_table": external_parquet_table,
    "convert_database": convert_whole_database,
    "convert_database_at_once": convert_database_at_once,
    "convert_database_query": convert_whole_database_query,
    "convert_listed_datasets": convert_listed_datasets,
    "insert_rows": insert_rows,
    "convert_incremental": convert_incremental,
    "convert_incremental_report": convert_incremental_report,
    "convert_incremental_declared": convert_incremental_declared,
    "convert_incremental_declared_partitions": convert_incremental_declared_partitions,
    "convert_changed": convert_changed,
    "convert_replaced_partitions": convert_replaced_partitions,
    "convert_database_resumed": convert_database_resumed,
}

ORACLES = {
    "external_text_table": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority,
               'o_totalprice decimal(15,2)' AS types
        FROM orders WHERE o_orderdate >= '1997-01-01'
    """,
    "external_parquet_table": """
        SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate),
               'o_orderdate timestamp_ntz' AS types
        FROM orders WHERE o_orderstatus = 'F'
    """,
    "convert_database": " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS rows_read FROM {name}" for name in TEXT_TABLES
    ),
    "convert_database_at_once": " UNION ALL ".join(
        f"SELECT '{kind}{name}' AS dataset, count(*) AS rows_read FROM {name}"
        for name in TEXT_TABLES
        for kind in ("", "rows of ")
    ),
    "convert_database_query": """
        SELECT l_returnflag, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate,
               count(*) AS line_count,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS VARCHAR) AS total_price,
               'l_shipdate date' AS types
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_orderstatus = 'F' AND l_returnflag = 'R'
        GROUP BY l_returnflag, l_shipdate
    """,
    "convert_listed_datasets": """
        SELECT 'orders' AS dataset, count(*) AS rows_read FROM orders
        UNION ALL SELECT 'part', count(*) FROM part
        UNION ALL SELECT 'part price cents',
                         CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS BIGINT) FROM part
    """,
    "insert_rows": """
        SELECT o_orderpriority AS priority, count(*) AS order_count
        FROM orders GROUP BY o_orderpriority
        UNION ALL VALUES ('none', 0), (NULL, -1), ('inserted by 3', 2)
        UNION ALL SELECT 'inserted by 2', count(DISTINCT o_orderpriority) FROM orders
    """,
    "convert_incremental": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority,
               'o_orderdate date, o_totalprice decimal(15,2)' AS types
        FROM orders
    """,
    "convert_incremental_report": """
        SELECT o_orderstatus, count(*) AS order_count,
               (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS run_1,
               (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS run_2,
               CAST(0 AS BIGINT) AS run_3
        FROM orders GROUP BY o_orderstatus
    """,
    **dict.fromkeys(
        ["convert_incremental_declared", "convert_incremental_declared_partitions"],
        """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority,
               'o_orderdate date, o_totalprice decimal(15,2)' AS types,
               (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS seen_1,
               (SELECT count(*) FROM orders) AS seen_2, (SELECT count(*) FROM orders) AS seen_3
        FROM orders
    """,
    ),
    "convert_changed": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority,
               'o_orderdate date, o_totalprice decimal(15,2)' AS types,
               (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS seen_1,
               (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS seen_2,
               (SELECT count(*) FROM orders) AS seen_3
        FROM orders
    """,
    "convert_replaced_partitions": """
        SELECT o_orderstatus, count(*) AS order_count,
               CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1.00 ELSE CAST(o_totalprice AS DECIMAL(15,2)) END) AS VARCHAR) AS total
        FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0
        GROUP BY o_orderstatus
    """,
    "convert_database_resumed": " UNION ALL ".join(
        f"SELECT '{kind}{name}' AS dataset, count(*) AS rows_read, 2 AS done_before FROM {name}"
        for name in ("customer", "nation", "orders", "supplier")
        for kind in ("", "rows of ")
    ),
}
