"""The sample reports, over any tables that have the columns they name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableforge.names import column, quoted


def total_records(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("total_records"))


def active_since(
    table: DataFrame, columns: Sequence[str], date: str, since: str, status: str, value: str
) -> DataFrame:
    """The columns of rows with the given status, from the given date on."""
    rows = table.filter((column(date) >= F.lit(since)) & (column(status) == F.lit(value)))
    return rows.select(*map(column, columns))


def totals_by(table: DataFrame, key: str, amount: str) -> DataFrame:
    """Rows and average amount per key, largest group first."""
    groups = table.groupBy(column(key)).agg(
        F.count(F.lit(1)).alias("row_count"), F.avg(column(amount)).alias("avg_amount")
    )
    return groups.orderBy(F.desc("row_count"))


def with_partner_since(
    facts: DataFrame,
    partners: DataFrame,
    fact_key: str,
    partner_key: str,
    fact_columns: Sequence[str],
    partner_columns: Sequence[str],
    date: str,
    since: str,
) -> DataFrame:
    """Facts from a date on with columns of their partner rows.

    No join hint: whether the partner side is small enough to broadcast is
    decided by its measured size, and a hot key is split at run time.
    """
    f, p = facts.alias("f"), partners.alias("p")
    matched = f.join(p, F.col(f"f.{quoted(fact_key)}") == F.col(f"p.{quoted(partner_key)}"))
    return matched.filter(F.col(f"f.{quoted(date)}") >= F.lit(since)).select(
        *(F.col(f"f.{quoted(name)}") for name in fact_columns),
        *(F.col(f"p.{quoted(name)}") for name in partner_columns),
    )


def above_average(table: DataFrame, name: str, amount: str) -> DataFrame:
    """Rows above the overall average, and that average, by scalar subqueries."""
    session = table.sparkSession
    return session.sql(
        f"""
        SELECT {quoted(name)}, {quoted(amount)},
               (SELECT avg({quoted(amount)}) FROM {{rows}}) AS avg_amount
        FROM {{rows}}
        WHERE {quoted(amount)} > (SELECT avg({quoted(amount)}) FROM {{rows}})
        """,
        rows=table,
    )
