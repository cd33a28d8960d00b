"""Row and column selection."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.sources.schemas import require_columns


def lowercase_columns(df: DataFrame) -> DataFrame:
    """All column names in lower case; names that differ only in case are an error."""
    names = [name.lower() for name in df.columns]
    clashes = [name for name, times in Counter(names).items() if times > 1]
    if clashes:
        raise ValueError(f"columns differ only in case: {', '.join(clashes)}")
    return df.toDF(*names)


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """These columns in this order; all missing ones are named at once."""
    return require_columns(df, columns).select(*[F.col(f"`{name}`") for name in columns])


def select_features(columns: list[str], exclude: list[str]) -> list[str]:
    """The columns that are not excluded, in their order."""
    excluded = set(exclude)
    return [name for name in columns if name not in excluded]


def keep_present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a value in all these columns."""
    return df.dropna(subset=list(columns))


def keep_in(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows whose value is listed."""
    return df.filter(F.col(col).isin(list(values)))


def keep_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows with lo <= value < hi; null drops out."""
    return df.filter((F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi)))


def by_date(df: DataFrame, date_col: str, ranges: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """One DataFrame per named range [from, to) of ISO dates. Rows in no range are in none of them.

    Each is a plain filter on the column, which reaches the file scan.
    """
    return {
        name: keep_between(df, date_col, F.lit(start).cast("date"), F.lit(end).cast("date"))
        for name, (start, end) in ranges.items()
    }


def tag_by_date(df: DataFrame, date_col: str, ranges: dict[str, tuple[str, str]], out: str = "tag") -> DataFrame:
    """The rows of all ranges in one DataFrame, each with the name of the (first) range it falls in."""
    date = F.col(date_col)
    tag = F.lit(None).cast("string")
    for name, (start, end) in reversed(ranges.items()):
        inside = (date >= F.lit(start).cast("date")) & (date < F.lit(end).cast("date"))
        tag = F.when(inside, F.lit(name)).otherwise(tag)
    return df.withColumn(out, tag).filter(F.col(out).isNotNull())
