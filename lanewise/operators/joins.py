"""Enrichment by lookup, and joining group results back to rows.

No side is ever forced to be broadcast. Spark broadcasts a side only when its measured size is below
`spark.sql.autoBroadcastJoinThreshold`; beyond that it shuffles both sides, and adaptive execution splits the
partitions that hot keys make too large. It can do so only where both sides come straight from a shuffle, and not where
one side keeps the partitions of an aggregate on the same keys. Aggregated lookups are therefore staged first, which
also gives their true size.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.operators.dedup import keys_are_unique, lowest_per_key
from lanewise.sources.tables import stage

SALT = "__salt"


def _renamed(columns: list[str] | dict[str, str]) -> dict[str, str]:
    return dict(columns) if isinstance(columns, dict) else {name: name for name in columns}


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: list[str] | dict[str, str],
    take: list[str] | dict[str, str],
    how: str = "left",
    on_duplicate: str = "allow",
    spread: int = 1,
    hot_share: float | None = None,
) -> DataFrame:
    """Add columns of `dim` to the rows of `df`.

    on            key columns, or {column of df: column of dim}; null keys match nothing
    take          columns of dim to add, or {column of dim: name to give it}
    how           "left" keeps unmatched rows, "inner" drops them
    on_duplicate  "allow": a repeated key of dim repeats the row, as a plain join does
                  "first": the lowest taken values win, compared in the order of `take`, nulls first (staged)
                  "error": a repeated key raises
    spread        for a dim too large to broadcast: copies of each dim row over which the rows of one key are
                  divided, so that a hot key is joined by that many tasks
    hot_share     the same for hot keys alone: keys that hold this share of the rows or more are found beforehand (`hot_keys`,
                  a pass over the key columns), each is divided by its size, and only its rows of dim are copied
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    if on_duplicate not in ("allow", "first", "error"):
        raise ValueError(f"on_duplicate must be allow, first or error, not {on_duplicate}")
    on, take = _renamed(on), _renamed(take)
    taken = {name.lower() for name in df.columns} & {name.lower() for name in take.values()}
    if taken:
        raise ValueError(f"columns are there already: {', '.join(sorted(taken))}")
    side = dim.select(
        *[F.col(theirs).alias(f"__key_{ours}") for ours, theirs in on.items()],
        *[F.col(theirs).alias(ours) for theirs, ours in take.items()],
    )
    dim_keys = [f"__key_{ours}" for ours in on]
    if on_duplicate == "first":
        side = stage(lowest_per_key(side, dim_keys, list(take.values())), name="lookup")
    elif on_duplicate == "error" and not keys_are_unique(side, dim_keys):
        raise ValueError(f"lookup keys are not unique: {', '.join(on.values())}")

    conditions = [F.col(ours) == F.col(theirs) for ours, theirs in zip(on, dim_keys)]
    if hot_share is not None:
        if spread > 1:
            raise ValueError("give spread or hot_share, not both")
        hot = hot_keys(df, list(on), hot_share)
        if hot:
            parts = max(2, *hot.values())
            ours, theirs = (_copies(F.xxhash64(*[F.col(key) for key in keys]), hot) for keys in (list(on), dim_keys))
            df = df.withColumn(SALT, F.pmod(_salt(df, parts), ours))
            side = side.withColumn(f"{SALT}_dim", F.explode(F.sequence(F.lit(0), theirs - 1)))
            conditions.append(F.col(SALT) == F.col(f"{SALT}_dim"))
    if spread > 1:
        df = df.withColumn(SALT, _salt(df, spread))
        side = side.withColumn(f"{SALT}_dim", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        conditions.append(F.col(SALT) == F.col(f"{SALT}_dim"))
    joined = df.join(side, reduce(and_, conditions), how)
    return joined.drop(*dim_keys, SALT, f"{SALT}_dim")


def hot_keys(df: DataFrame, keys: list[str], share: float) -> dict[int, int]:
    """Hashes of the keys that hold `share` of the rows or more, with the number of parts to deal each key's rows into.

    A mergeable sketch of frequent items is filled by each task and merged, in one pass over the key columns; it tracks so
    many items that counts are off by less than a quarter of `share`. A key a little below the share may be among those
    found. At most 4 / (3 * share) keys reach the driver, however many there are. A key's parts hold `share` of the rows each.
    """
    if not 0 < share < 1:
        raise ValueError("a share lies between 0 and 1")
    tracked = 1 << (math.ceil(16 / share) - 1).bit_length()
    most = math.ceil(4 / (3 * share))
    found = df.select(F.xxhash64(*keys).alias("__key")).agg(F.expr(f"approx_top_k(__key, {most}, {tracked})").alias("top"), F.count("*").alias("n")).first()
    return {item["item"]: math.ceil(item["count"] / (share * found["n"])) for item in found["top"] or [] if 4 * item["count"] >= 3 * share * found["n"]}


def _copies(key: Column, hot: dict[int, int]) -> Column:
    """Into how many parts the rows of a key are dealt: one, if it is not hot."""
    parts = F.lit(1)
    for number in sorted(set(hot.values()) - {1}):
        parts = F.when(key.isin([item for item, count in hot.items() if count == number]), number).otherwise(parts)
    return parts


def _salt(df: DataFrame, spread: int):
    """A bucket 0..spread-1 per row that a rerun of the task gives again.

    The row's hash divides different rows of a key; the partition number divides copies of one row.
    """
    return F.pmod(F.hash(*df.columns) + F.spark_partition_id(), F.lit(spread))


def join_groups(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Add the columns of `groups` (one row per key) to every row of its group; null keys are groups too."""
    side = groups.withColumnsRenamed({key: f"__key_{key}" for key in keys})
    same_group = reduce(and_, [F.col(key).eqNullSafe(F.col(f"__key_{key}")) for key in keys])
    return df.join(side, same_group, "left").drop(*[f"__key_{key}" for key in keys])
