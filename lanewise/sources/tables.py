"""Scans, sinks and staging."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.session import staging_path
from lanewise.sources.schemas import conform, require_columns


def read_table(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A catalog table or view; with `schema`, checked and cast to it."""
    df = spark.table(name)
    return conform(df, schema) if schema is not None else df


def read(spark: SparkSession, path: str, format: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A directory of parquet, CSV (with header), ORC or JSON files; with `schema`, checked and cast to it.

    CSV columns are always read as text and matched by header name, so a leading zero of a postcode stays and
    extra columns do no harm.
    """
    reader = spark.read
    if format == "csv":
        reader = reader.option("header", True)
    if format == "json" and schema is not None:
        reader = reader.schema(schema)  # else a full pass would guess types, and a code such as 00501 would lose its zeros
    df = reader.format(format).load(path)
    return conform(df, schema) if schema is not None else df


def read_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of a directory of CSV files with a header: the records that parse, in `schema`, and those that do not.

    A record is rejected if it has more or fewer fields than the header, or a field that is there but does not parse as its
    column's type. `rejected` has its file, its text, and the reason. Empty fields are nulls and reject nothing; empty
    lines are no records. Columns that `schema` lacks are counted but not read. Both tables are read lazily from one parse.
    """
    header = spark.read.option("header", True).csv(path).schema
    taken = {name.lower() for name in header.names}
    text, place = ("__record", "__file")
    if {text, place} & taken:
        raise ValueError(f"a column must not be called {text} or {place}")
    raw = T.StructType([*[T.StructField(name, T.StringType()) for name in header.names], T.StructField(text, T.StringType())])
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", text)
    records = reader.schema(raw).csv(path).withColumn(place, F.col("_metadata.file_path"))
    require_columns(records, schema.names)
    lost = [F.when(F.col(field.name).isNotNull() & F.col(field.name).try_cast(field.dataType).isNull(), field.name) for field in schema.fields]
    wrong = F.concat_ws(", ", *lost)
    reason = F.when(F.col(text).isNotNull(), "number of fields").when(wrong != "", F.concat(F.lit("does not parse: "), wrong))
    records = records.withColumn("__reason", reason)
    # What was a record's text is known for broken ones; of others it is put together again from their fields.
    whole = F.coalesce(F.col(text), F.concat_ws(",", *[F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in header.names]))
    rejected = records.filter("__reason IS NOT NULL").select(F.col(place).alias("file"), whole.alias("record"), F.col("__reason").alias("reason"))
    return conform(records.filter("__reason IS NULL"), schema), rejected


def write(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    format: str = "parquet",
    partitions: int | None = None,
    partition_by: list[str] | None = None,
    range_by: list[str] | None = None,
) -> str:
    """Write a directory of part files and return its path.

    `partitions` spreads rows evenly over that many files at the price of a shuffle; leave it out to keep the
    partitions the plan ends with. `range_by` deals rows out by ranges of these columns instead, so that a filter on
    the first of them skips files by their statistics; the others split the rows of a frequent value.
    """
    if range_by:
        df = df.repartitionByRange(*([partitions] if partitions is not None else []), *range_by)
    elif partitions is not None:
        df = df.repartition(partitions)
    writer = df.write.mode(mode).format(format)
    if format == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def stage(
    df: DataFrame, path: str | None = None, partitions: int | None = None, name: str = "table", range_by: list[str] | None = None
) -> DataFrame:
    """Write `df` and read it back.

    This cuts lineage in storage that outlives executors, lets later steps read single columns, and gives
    Spark the table's true size, so that a join picks broadcast or shuffle by what was really written.
    """
    spark = df.sparkSession
    path = path or staging_path(spark, name)
    write(df, path, partitions=partitions, range_by=range_by)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage independent tables side by side, so that small ones do not wait for each other."""
    if not tables:
        return {}

    def task(name: str, df: DataFrame):
        path = staging_path(df.sparkSession, name)  # in this thread, whose `scratch` block it is
        # Wrapped one by one: each thread must have its own copy of the job properties.
        return inheritable_thread_target(df.sparkSession)(lambda: stage(df, path))

    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        running = {name: pool.submit(task(name, df)) for name, df in tables.items()}
        return {name: done.result() for name, done in running.items()}

