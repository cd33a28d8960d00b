"""Checks of a table's size and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, columns, distinct keys (null counts as a value) and nulls per column, in one job."""
    nulls = [F.count_if(F.col(f"`{name}`").isNull()).alias(f"nulls_{name}") for name in df.columns]
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_distinct(F.struct(*keys)).alias("key_count"),
        *nulls,
    ).withColumn("column_count", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> dict[str, str]:
    """Name and type of each column; reads no data."""
    return dict(df.dtypes)
