"""Tables, texts and staging shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.session import staging_path

WORDS_SQL = r"[^\x20\x09-\x0D]+"
#: Characters of a block of documents; a block is held by one task. Spark bounds the batches that reach Python
#: (spark.sql.execution.arrow.maxBytesPerBatch), so long texts come few at a time.
BLOCK_CHARS = 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), whatever else the table holds; a missing text is an empty one."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )


def words_of(text: str) -> list[bytes]:
    """The runs of anything but space and tab to carriage return, as UTF-8; A-Z in lower case."""
    return text.encode().lower().split()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage_bucketed(df: DataFrame, column: str, buckets: int, name: str) -> DataFrame:
    """Write `df` to the shared folder in hash buckets of `column`, without a shuffle, and read it back.

    A later join on the column moves only the other side, which matters where rows carry whole token arrays.
    """
    spark = df.sparkSession
    path, entry = staging_path(spark, name), f"llm_{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, column).option("path", path).saveAsTable(entry)
    found = spark.table(entry)
    found.schema  # resolved now; the files stay when the name goes
    spark.sql(f"DROP TABLE {entry}")
    return found


def block_ids() -> Iterator[int]:
    """Numbers no other task gets: the partition's number, then a counter. The caller stages what it numbers."""
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 32
    yield from range(first, first + (1 << 32))


def as_blocks(frames: Iterator[pd.DataFrame], max_chars: int) -> Iterator[tuple[int, list, list[str]]]:
    """(block, ids, texts): consecutive documents of up to about `max_chars` characters; a longer one stands alone."""
    ids, held, size, numbers = [], [], 0, block_ids()
    for frame in frames:
        for key, text in zip(frame["doc_id"].astype("Int64").array, frame["text"]):
            if held and size + len(text) > max_chars:
                yield next(numbers), ids, held
                ids, held, size = [], [], 0
            ids.append(None if key is pd.NA else int(key))
            held.append(text)
            size += len(text)
    if held:
        yield next(numbers), ids, held


def group_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links between them, the smallest node of each node's component."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        after = label.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        np.minimum.at(after, label[left], low)
        np.minimum.at(after, label[right], low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    return label
