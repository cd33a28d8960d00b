"""Run queries on Spark and their SQL on DuckDB over the same files and compare all values.

    python -m shipment_checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd

from lanewise.session import local_session
from shipment_checks.catalog import ORACLE, QUERIES


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def rows(frame: pd.DataFrame) -> Counter:
    """The rows as a bag, columns sorted by name, missing values alike."""
    frame = frame[sorted(frame.columns)].astype(object)
    return Counter(frame.where(frame.notna(), None).itertuples(index=False, name=None))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns differ: {sorted(set(spark_frame.columns) ^ set(sql_frame.columns))}"
    kinds = {
        name: (str(spark_frame[name].dtype), str(sql_frame[name].dtype))
        for name in spark_frame.columns
        if str(spark_frame[name].dtype) != str(sql_frame[name].dtype)
    }
    if len(spark_frame) != len(sql_frame):
        return f"rows differ: {len(spark_frame)} and {len(sql_frame)}"
    ours, theirs = rows(spark_frame), rows(sql_frame)
    if ours != theirs:
        only, other = (ours - theirs), (theirs - ours)
        return f"{sum(only.values())} rows differ, such as\n  {next(iter(only))}\n  {next(iter(other))}"
    return f"types differ: {kinds}" if kinds else None


def main(sf_dir: str, names: list[str]) -> int:
    spark = local_session("compare", cpus=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = connect(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        frame = QUERIES[name](spark, sf_dir).toPandas()
        seconds = time.time() - start
        found = difference(frame, connection.execute(ORACLE[name]).df()) if name in ORACLE else "rows only"
        failures += found is not None and found != "rows only"
        print(f"{name:30} {seconds:6.2f}s {len(frame):8} rows  {found or 'equal'}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
