"""Results of statements, written to an output location."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from tableforge.names import column


def write_result(df: DataFrame, path: str, result_format: str = "csv", mode: str = "overwrite") -> int:
    """Write a query result and return its number of rows.

    "csv" has a header line, and nested values as JSON; "parquet" keeps the types.
    """
    if result_format not in ("csv", "parquet"):
        raise ValueError(f"result_format must be 'csv' or 'parquet', not {result_format!r}")
    counter = Observation()
    rows = _unique_names(df).observe(counter, F.count(F.lit(1)).alias("rows"))
    if result_format == "parquet":
        rows.write.mode(mode).parquet(path)
    else:
        flat = rows.select(
            *(
                F.to_json(column(f.name)).alias(f.name)
                if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))
                else column(f.name)
                for f in rows.schema.fields
            )
        )
        flat.write.mode(mode).options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
    return counter.get["rows"]


def _unique_names(df: DataFrame) -> DataFrame:
    """Files cannot hold two columns of one name; a query result can."""
    seen: set[str] = set()
    names = []
    for name in df.columns:
        unique, suffix = name, 1
        while unique.lower() in seen:
            suffix += 1
            unique = f"{name}_{suffix}"
        seen.add(unique.lower())
        names.append(unique)
    return df if names == df.columns else df.toDF(*names)
