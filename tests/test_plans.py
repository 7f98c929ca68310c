"""Plans of the reports: what reaches the scan, and what is shuffled."""

from __future__ import annotations

import re

from conftest import SMALL, plan_of
from pyspark.sql import functions as F

from tableforge import write_parquet
from tableforge.plans import reports


def orders(spark):
    return spark.read.parquet(f"{SMALL}/orders.parquet")


def test_filters_and_columns_reach_the_scan(spark):
    rows = reports.active_since(
        orders(spark), ["o_orderkey"], "o_orderdate", "1997-01-01", "o_orderstatus", "F"
    )
    plan = plan_of(rows)
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan)[1]
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in pushed
    assert "EqualTo(o_orderstatus,F)" in pushed
    read = re.search(r"ReadSchema: struct<(.*)>", plan)[1]
    assert {c.split(":")[0] for c in read.split(",")} == {"o_orderkey", "o_orderdate", "o_orderstatus"}
    assert "Exchange" not in plan


def test_count_reads_no_column(spark):
    plan = plan_of(reports.total_records(orders(spark)))
    assert "ReadSchema: struct<>" in plan
    assert "partial_count" in plan


def test_groups_are_pre_aggregated(spark):
    plan = plan_of(reports.totals_by(orders(spark), "o_orderpriority", "o_totalprice"))
    assert "partial_count" in plan and "partial_avg" in plan
    assert "ReadSchema: struct<o_totalprice:double,o_orderpriority:string>" in plan


def joined(spark):
    return reports.with_partner_since(
        orders(spark),
        spark.read.parquet(f"{SMALL}/customer.parquet"),
        "o_custkey",
        "c_custkey",
        ["o_orderkey"],
        ["c_name"],
        "o_orderdate",
        "1997-01-01",
    )


def test_join_is_chosen_by_size(spark):
    assert "BroadcastHashJoin" in plan_of(joined(spark))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        plan = plan_of(joined(spark))
    finally:
        spark.conf.set(setting, before)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in plan


def test_hot_join_key_is_split(spark):
    """One customer with two thirds of the rows: several tasks join it."""
    facts = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 1000).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.lit("1998-01-01").alias("d"),
    )
    partners = spark.range(1000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = reports.with_partner_since(facts, partners, "k", "k", ["v"], ["name"], "d", "1997")
        assert len(rows.collect()) == 300_000
        plan = plan_of(rows, "simple")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in plan


def test_average_is_a_subquery(spark):
    plan = plan_of(
        reports.above_average(spark.read.parquet(f"{SMALL}/part.parquet"), "p_name", "p_retailprice")
    )
    assert "Subquery" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_partition_filters_prune_folders(spark, folder):
    write_parquet(orders(spark), f"{folder}/out", partition_keys="o_orderstatus")
    plan = plan_of(spark.read.parquet(f"{folder}/out").filter("o_orderstatus = 'F'").select("o_orderkey"))
    assert re.search(r"PartitionFilters: \[.*o_orderstatus#\d+ = F", plan)
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
