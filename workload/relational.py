"""Sample reports on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableforge.plans import reports
from tableforge.plans.batch import BatchOptions, run_batch
from tableforge.sources.catalog import declare_parquet_table
from tableforge.workspace import new_folder
from workload.staging import comparable, new_database, table


def count_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.total_records(table(spark, sf_dir, "lineitem"))


def count_quoted_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, out = new_database(spark, "quoted"), new_folder(spark, "results")
    lineitem = table(spark, sf_dir, "lineitem")
    declare_parquet_table(
        spark, f"{database}.lineitem", lineitem.schema, f"{sf_dir}/lineitem.parquet"
    )
    run_batch(
        spark,
        [f'SELECT count(*) AS "total_records" FROM "{database}"."lineitem" LIMIT 10'],
        out,
        BatchOptions(result_format="parquet", double_quoted_names=True),
    )
    return spark.read.parquet(f"{out}/1")


def filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.active_since(
        table(spark, sf_dir, "orders"),
        ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
        date="o_orderdate",
        since="1997-01-01",
        status="o_orderstatus",
        value="F",
    )
    return comparable(rows)


def select_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(table(spark, sf_dir, "orders").select("*"))


def group_count_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = reports.totals_by(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")
    return totals.select(
        "o_orderpriority",
        F.col("row_count").alias("order_count"),
        F.round("avg_amount", 2).alias("avg_price"),
    )


def inner_join_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.with_partner_since(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"),
        "o_custkey",
        "c_custkey",
        ["o_orderkey", "o_totalprice"],
        ["c_name", "c_mktsegment"],
        date="o_orderdate",
        since="1997-01-01",
    )


def scalar_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    above = reports.above_average(table(spark, sf_dir, "part"), "p_name", "p_retailprice")
    return above.select("p_name", "p_retailprice", F.round("avg_amount", 2).alias("avg_price"))


QUERIES = {
    "count_all": count_all,
    "count_quoted_limit": count_quoted_limit,
    "filter_project": filter_project,
    "select_star": select_star,
    "group_count_avg": group_count_avg,
    "inner_join_filter": inner_join_filter,
    "scalar_subquery": scalar_subquery,
}

ORACLES = {
    "count_all": "SELECT count(*) AS total_records FROM lineitem",
    "count_quoted_limit": 'SELECT count(*) AS "total_records" FROM "lineitem" LIMIT 10',
    "filter_project": """
        SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
               'o_orderdate timestamp_ntz' AS types
        FROM orders WHERE o_orderdate >= '1997-01-01' AND o_orderstatus = 'F'
    """,
    "select_star": """
        SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate),
               'o_orderdate timestamp_ntz' AS types
        FROM orders
    """,
    "group_count_avg": """
        SELECT o_orderpriority, count(*) AS order_count, round(avg(o_totalprice), 2) AS avg_price
        FROM orders GROUP BY o_orderpriority ORDER BY order_count DESC
    """,
    "inner_join_filter": """
        SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderdate >= '1997-01-01'
    """,
    "scalar_subquery": """
        SELECT p_name, p_retailprice,
               round((SELECT avg(p_retailprice) FROM part), 2) AS avg_price
        FROM part WHERE p_retailprice > (SELECT avg(p_retailprice) FROM part)
    """,
}
