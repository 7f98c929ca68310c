"""Every registered query against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle import differences

import __spark_entry__ as registry
import workload


def test_every_query_has_sql():
    assert set(workload.QUERIES) == set(workload.ORACLES)
    assert set(workload.QUERIES) <= set(registry.queries())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query_equals_sql(spark, name):
    assert differences(spark, name, SMALL) == []


def test_entry(spark):
    report = registry.entry(spark)
    assert report.columns == ["o_orderpriority", "order_count", "avg_price"]
    counts = [row["order_count"] for row in report.collect()]
    assert counts == sorted(counts, reverse=True) and sum(counts) > 0
