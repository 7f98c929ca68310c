"""Casts of a whole DataFrame to the columns of a target table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tableforge.functions.casts import DATE_FORMAT, TIME_OF_DAY_FORMAT, cast_column, cast_to_declared
from tableforge.names import Columns, column
from tableforge.session import bad_casts_give_null


def cast_to_columns(
    df: DataFrame,
    target: Columns,
    date_format: str = DATE_FORMAT,
    timestamp_format: str = TIME_OF_DAY_FORMAT,
    declared: bool = False,
) -> DataFrame:
    """Cast the columns that ``target`` names, in one projection.

    Columns are matched by name. Target columns that ``df`` lacks are skipped;
    columns that ``target`` lacks are kept as they are. The order stays. With
    ``declared`` each column ends in exactly its type of a catalog table; otherwise
    ``float`` means double, and types the conversion does not know change nothing.
    """
    wanted = dict(target)
    cast = cast_to_declared if declared else cast_column
    casts = [
        cast(
            column(name), type_name, wanted.get(name, type_name), date_format, timestamp_format
        ).alias(name)
        for name, type_name in df.dtypes
    ]
    with bad_casts_give_null(df.sparkSession):
        return df.select(*casts)
