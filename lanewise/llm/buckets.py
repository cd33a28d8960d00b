"""Rows that share a bucket key, dealt into tiles of bounded size so that each pair of a bucket meets exactly once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.common import group_labels
from lanewise.sources import stage

#: A bucket of more rows is split into parts of about this many; a tile holds one part or two.
PART_ROWS = 1024
#: Links gathered before they are reduced to a forest.
HELD_LINKS = 1_000_000


def tiles(rows: DataFrame, item: str, part_rows: int = PART_ROWS) -> DataFrame:
    """`rows` (with column `key`) whose key occurs twice or more, with columns `tile`, `part` and `own` (a tile of one part).

    A bucket of s rows has p = ceil(s / part_rows) parts, by a hash of `item`. Tile (i, j) holds parts i <= j, so a row
    of a large bucket stands in p tiles and no tile exceeds two parts, whatever the share of the bucket. Sizes are
    counted with a partial step and written first, so that the join with them can be split where a key is hot.
    """
    sizes = stage(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), name="sizes")
    parts = F.ceil(F.col("size") / part_rows).cast("int")
    dealt = rows.join(sizes, "key").withColumn("parts", parts)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64(F.col(item), F.lit(7)), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    dealt = dealt.select("*", other)
    low, high = F.least("part", "other").cast("long"), F.greatest("part", "other").cast("long")
    dealt = dealt.withColumn("tile", low * F.col("parts") + high).withColumn("own", F.col("part") == F.col("other"))
    return dealt.drop("size", "parts", "other")


def pairs(frame: pd.DataFrame, check: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs that stand in one tile and pass `check`, some at a time.

    The frame holds whole tiles, one after another. Rows at distance 1, 2, ... are compared all at once over all tiles.
    In a tile of two different parts only rows of different parts meet; pairs of one part meet in that part's own tile.
    """
    key, tile, part, own = (frame[name].to_numpy() for name in ("key", "tile", "part", "own"))
    new = np.ones(len(frame), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])
    group = np.cumsum(new) - 1
    ends = np.append(np.flatnonzero(new)[1:], len(frame))[group]
    index = np.arange(len(frame))
    shift = 1
    alive = index[index + shift < ends]
    while len(alive):
        left, right = alive, alive + shift
        meet = own[left] | (part[left] != part[right])
        left, right = left[meet], right[meet]
        if len(left):
            good = check(left, right)
            if good.any():
                yield left[good], right[good]
        shift += 1
        alive = alive[alive + shift < ends[alive]]


def forest(n: int, found: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Component labels over the pairs found; never holds more than about `HELD_LINKS` of them."""
    label, held, count = np.arange(n), [], 0

    def reduced(label):
        left = np.concatenate([x for x, _ in held] + [np.arange(n)])
        right = np.concatenate([x for _, x in held] + [label])
        return group_labels(n, left, right)

    for pair in found:
        held.append(pair)
        count += len(pair[0])
        if count > HELD_LINKS:
            label, held, count = reduced(label), [], 0
    return reduced(label) if held else label
