"""Codes for columns with very many values: a dictionary that is a table, and sparse vectors in place of one column per value."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewise.operators.encoding import encoded_values
from lanewise.operators.joins import lookup
from lanewise.sources.tables import stage


def _ranked(values: DataFrame, partitions: int | None) -> DataFrame:
    """(col, value, code): the place of each value among those of its column, from 0.

    Values are dealt out by ranges and counted within; only the first place of each range and column is gathered, so no task
    and no driver holds a column's values.
    """
    keys = ["col", "value"]
    dealt = values.repartitionByRange(*([partitions] if partitions else []), *keys).sortWithinPartitions(*keys)
    placed = stage(dealt.withColumn("__row", F.monotonically_increasing_id()).withColumn("__part", F.spark_partition_id()), name="values")
    ranges = placed.groupBy("col", "__part").agg(F.count("*").alias("n"), F.min("__row").alias("first"))
    before = F.sum("n").over(Window.partitionBy("col").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    ranges = stage(ranges.select("col", "__part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("__shift")), name="ranges")
    return placed.join(ranges, ["col", "__part"]).select("col", "value", (F.col("__row") + F.col("__shift")).alias("code"))


def dictionary(df: DataFrame, cols: list[str], known: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """(col, value, code, version): a code from 0 for each value of each column, in the order of the values as text.

    With `known`, an earlier dictionary, its codes and versions stay, and values it lacks get the codes that follow, under the
    next version. So models and rows coded before keep their meaning, and `version <= n` gives the dictionary as it was.
    Null has no code. Write the result to keep it; it is staged, and nothing of it reaches the driver.
    """
    values = encoded_values(df, cols)
    if known is None:
        return stage(_ranked(values, partitions).withColumn("version", F.lit(1)), name="dictionary")
    values = values.join(known.select("col", "value"), ["col", "value"], "left_anti")
    new = _ranked(values, partitions)
    next_codes = known.groupBy("col").agg(F.max("code").alias("__last"))
    version = known.agg(F.coalesce(F.max("version"), F.lit(0)) + 1).first()[0]
    new = new.join(next_codes, "col", "left")
    code = F.col("code") + F.coalesce(F.col("__last") + 1, F.lit(0))
    new = new.select("col", "value", code.alias("code"), F.lit(version).cast("int").alias("version"))
    return stage(known.select("col", "value", "code", F.col("version").cast("int").alias("version")).unionByName(new), name="dictionary")


def code_name(col: str) -> str:
    return f"{col}_code"


def with_codes(df: DataFrame, known: DataFrame, cols: list[str], hot_share: float | None = None) -> DataFrame:
    """Add `<col>_code` per column; null and values that the dictionary lacks have none. `hot_share` as in `lookup`."""
    for col in cols:
        side = known.filter(F.col("col") == col).select("value", "code")
        key = f"__text_{col}"
        df = df.withColumn(key, F.col(f"`{col}`").cast("string"))
        df = lookup(df, side, {key: "value"}, {"code": code_name(col)}, hot_share=hot_share).drop(key)
    return df


def sizes(known: DataFrame, cols: list[str]) -> dict[str, int]:
    """Codes per column, one number each."""
    found = {row["col"]: row["n"] for row in known.groupBy("col").agg((F.max("code") + 1).alias("n")).collect()}
    return {col: found.get(col, 0) for col in cols}


def with_vector(df: DataFrame, known: DataFrame, cols: list[str], out: str = "indicators") -> DataFrame:
    """Add one sparse 0/1 vector over the values of all columns, one column's after the other's, by code.

    A last position per column stands for null and for values that the dictionary lacks. A row holds one entry per column,
    however many values there are.
    """
    count = sizes(known, cols)
    coded = with_codes(df, known, cols)
    filled = coded.withColumns({f"__{col}": F.coalesce(code_name(col), F.lit(count[col])).cast("double") for col in cols})
    # The sizes are given by one row per column, so that the encoder does not have to look through the data for them.
    spark = df.sparkSession
    largest = spark.createDataFrame([tuple(float(count[col]) for col in cols)], ", ".join(f"`__{col}` double" for col in cols))
    encoder = OneHotEncoder(inputCols=[f"__{col}" for col in cols], outputCols=[f"__vector_{col}" for col in cols], dropLast=False)
    vectors = encoder.fit(largest).transform(filled)
    joined = VectorAssembler(inputCols=[f"__vector_{col}" for col in cols], outputCol=out).transform(vectors)
    return joined.select(*[F.col(f"`{name}`") for name in df.columns], out)
