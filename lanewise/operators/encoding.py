"""One-hot columns."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def encoded_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(col, value) for the distinct non-null values of each column, as text, found in one pass."""
    present = df.select(*[F.col(f"`{col}`").alias(f"c{number}") for number, col in enumerate(cols)]).distinct()
    pairs = F.array(
        *[F.struct(F.lit(col).alias("col"), F.col(f"c{number}").cast("string").alias("value")) for number, col in enumerate(cols)]
    )
    return present.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()


def value_domains(df: DataFrame, cols: list[str], max_values: int | None = None) -> dict[str, list]:
    """The sorted distinct non-null values of each column.

    They become columns, so they reach the driver. With `max_values` a column that has more is an error, and at most
    `max_values` + 1 values of each column are fetched to find that out.
    """
    values = encoded_values(df, cols)
    if max_values is not None:
        rank = F.row_number().over(Window.partitionBy("col").orderBy("value"))
        values = values.withColumn("rank", rank).filter(F.col("rank") <= max_values + 1)
    rows = values.collect()

    domains = {}
    for col in cols:
        found = [row["value"] for row in rows if row["col"] == col]
        if max_values is not None and len(found) > max_values:
            raise ValueError(f"{col} has more than {max_values} values; one column for each is no use")
        kind = df.schema[col].dataType.typeName()
        if kind in ("byte", "short", "integer", "long"):
            found = [int(value) for value in found]
        elif kind != "string":
            raise TypeError(f"{col} is {kind}; only text and whole numbers can be encoded")
        domains[col] = sorted(found)
    return domains


def one_hot(
    df: DataFrame, cols: list[str], domain: dict[str, list] | None = None, max_values: int | None = None
) -> tuple[DataFrame, dict[str, list]]:
    """Add a 0/1 column `<col>_<value>` per value of each column, and return the values used.

    Pass the domain of an earlier call to give other rows the same columns; columns it does not have are looked up
    in the rows. Null and values outside the domain have 0 in all of them. Names that differ from another column's at
    most in upper and lower case are an error.
    """
    domain = dict(domain or {})
    unknown = [col for col in cols if col not in domain]
    if unknown:
        domain.update(value_domains(df, unknown, max_values))
    indicators = [
        F.coalesce((F.col(f"`{col}`") == F.lit(value)).cast("int"), F.lit(0)).alias(f"{col}_{value}")
        for col in cols
        for value in domain[col]
    ]
    names = [*df.columns, *(f"{col}_{value}" for col in cols for value in domain[col])]
    seen = Counter(name.lower() for name in names)
    clashes = [name for name in names if seen[name.lower()] > 1]
    if clashes:
        raise ValueError(f"columns differ in case only or not at all: {', '.join(clashes)}")
    return df.select("*", *indicators), domain
