"""Row selection by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order_by: list[Column], tiebreak: list[Column]) -> DataFrame:
    """The first row of each key.

    `tiebreak` must settle what `order_by` leaves equal, or which row wins would depend on the run. Spark
    keeps one row per key and task before the shuffle, so a key with very many rows does no harm.
    """
    if not tiebreak:
        raise ValueError("first_per_key needs a tiebreak: rows equal on order_by would be picked at random")
    window = Window.partitionBy(*keys).orderBy(*order_by, *tiebreak)
    rank = "__rank"
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def lowest_per_key(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The keys with their lowest values, compared in the order given; null is lowest.

    The same as `first_per_key` ordered by `values`, at less cost, for when no other columns are wanted.
    """
    lowest = F.min(F.struct(*values)).alias("__lowest")
    return df.groupBy(*keys).agg(lowest).select(*keys, "__lowest.*")


def drop_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows; null equals null."""
    return df.select(*columns).distinct() if columns else df.distinct()


def keys_are_unique(df: DataFrame, keys: list[str]) -> bool:
    """Whether no two rows share a key. Rows with a null in the key never join, so they are left out."""
    joinable = df.select(*keys).dropna()
    return joinable.groupBy(*keys).count().filter(F.col("count") > 1).isEmpty()
