"""Near-duplicate vectors: p-stable hashing for Euclidean distance, then exact cosines.

On unit vectors cosine c is the distance sqrt(2 - 2c). A projection on a Gaussian vector, shifted and cut into cells of
`width`, puts close vectors in one cell more often than distant ones. `Hashing.fit` joins so many projections in a table
that unrelated vectors rarely meet, and takes so many tables that a pair exactly at the threshold is found with the wanted
recall; closer pairs are found more often. Both numbers follow from the number of vectors alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.buckets import forest, pairs, tiles
from lanewise.llm.common import partitions
from lanewise.llm.components import components
from lanewise.llm.packing import whole_groups
from lanewise.sources import stage


def _same_cell(distance: float, width: float) -> float:
    """The chance that one shifted Gaussian projection puts two vectors at `distance` in one cell."""
    ratio = width / distance
    tail = math.erfc(ratio / math.sqrt(2)) / 2
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


@dataclass(frozen=True)
class Hashing:
    """Numbers of projections in a table and of tables, the cell width, and the seed."""

    projections: int
    tables: int
    width: float = 2.5
    seed: int = 42

    @classmethod
    def fit(cls, n: int, cosine: float = 0.9, recall: float = 0.97, width: float = 2.5) -> Hashing:
        near, far = _same_cell(math.sqrt(2 - 2 * cosine), width), _same_cell(math.sqrt(2), width)
        projections = max(4, math.ceil(math.log(max(n, 2)) / -math.log(far)))
        return cls(projections, math.ceil(math.log(1 - recall) / math.log(1 - near**projections)), width)

    def keys(self, units: np.ndarray) -> np.ndarray:
        """A 64-bit key per row and table."""
        rng = np.random.default_rng(self.seed)
        axes = rng.standard_normal((units.shape[1], self.tables * self.projections))
        shift = rng.uniform(0, self.width, self.tables * self.projections)
        mixers = rng.integers(0, 1 << 63, self.tables * self.projections, dtype=np.uint64) | np.uint64(1)
        out = []
        for first in range(0, len(units), 2048):
            cells = np.floor((units[first : first + 2048] @ axes + shift) / self.width).astype(np.int64).view(np.uint64)
            mixed = (cells * mixers).reshape(len(cells), self.tables, self.projections).sum(axis=2, dtype=np.uint64)
            out.append(mixed ^ (mixed >> np.uint64(29)))
        keys = np.concatenate(out) if out else np.empty((0, self.tables), dtype=np.uint64)
        return keys + np.arange(self.tables, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _matrix(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype="<f8").reshape(len(values), -1)


def _units(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that no square overflows
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.9, recall: float = 0.97, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id) per row of `vectors`.

    n_links counts the other rows within `cosine` that were found, component_id is the smallest vec_id that links reach,
    its own included. A vector that is missing, empty, zero, or has a missing or non-finite component links with
    nothing; so do vectors of different lengths. Equal vectors are one item with its number of copies, so that a vector
    which is a third of the table costs no more than another. Repeated ids stay: rows of one vec_id are as many vectors.
    A row without vec_id is linked and counted as others are, but is never the smallest; its component_id is missing if
    it is alone. An empty table gives an empty one.
    """
    spark = vectors.sparkSession

    def clean(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for value in frame["vector"]:
                row = None if value is None else np.asarray([np.nan if x is None else x for x in value], dtype="<f8")
                good = row is not None and len(row) and np.isfinite(row).all() and (row != 0).any()
                found.append((row + 0.0).tobytes() if good else None)
            yield pd.DataFrame({"vec_id": frame["vec_id"], "vector": found})

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = stage(rows.mapInPandas(clean, "vec_id long, vector binary"), name="vectors")
    valid = rows.where("vector IS NOT NULL")
    item = F.xxhash64("vector", F.lit(1)).alias("item")
    items = valid.groupBy("vector").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
    items = stage(items.select(item, "vector", "low", "copies", F.length("vector").alias("bytes")), name="items")
    sizes = [(r["bytes"], r["n"]) for r in items.groupBy("bytes").agg(F.count("*").alias("n")).collect()]  # a row per vector length

    found = None
    for width, n in sizes:
        same = items.where(F.col("bytes") == width)
        part = _linked(same, Hashing.fit(n, cosine, recall), cosine, partitions(spark))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))

    found = stage(found, name="found")
    counts = stage(found.where("n > 0").groupBy("node").agg(F.sum("n").alias("n")), name="counts")
    roots = components(found.where("root IS NOT NULL"), "node", "root")
    placed = items.join(roots, items["item"] == roots["node"], "left").select("item", "low", F.coalesce("root", "item").alias("root"))
    placed = stage(placed, name="roots")
    lows = stage(placed.groupBy("root").agg(F.min("low").alias("component_id")), name="components")
    known = items.select("item", "copies").join(placed.join(lows, "root").select("item", "component_id"), "item")
    known = known.join(counts.withColumnRenamed("node", "item"), "item", "left")
    known = stage(known.select("item", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")), name="known")
    marked = rows.select("vec_id", F.when(F.col("vector").isNotNull(), F.xxhash64("vector", F.lit(1))).alias("item"))
    return marked.join(known, "item", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )


def _linked(items: DataFrame, hashing: Hashing, cosine: float, n_partitions: int) -> DataFrame:
    """(node, root, n): forest links of the tiles, and per tile and item the rows it is linked with for the first time."""

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                keys = hashing.keys(_units(_matrix(frame["vector"]))).view(np.int64)
                yield pd.DataFrame({"item": frame["item"], "keys": list(keys)})

    keys = items.select("item", "vector").mapInPandas(keyed, "item long, keys array<long>")
    rows = stage(keys.select("item", F.explode("keys").alias("key")), name="keys")
    dealt = stage(tiles(rows, "item"), name="dealt").join(items.select("item", "vector", "copies"), "item")
    dealt = dealt.repartition(n_partitions, "key", "tile").sortWithinPartitions("key", "tile", "item")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, ["key", "tile"]):
            units, keys = _units(_matrix(frame["vector"])), frame["key"].to_numpy().astype(np.int64).view(np.uint64)
            item, copies = frame["item"].to_numpy().astype(np.int64), frame["copies"].to_numpy().astype(np.int64)
            totals = np.zeros(len(frame), dtype=np.int64)
            own: dict[int, np.ndarray] = {}

            def of(rows):
                new = [row for row in np.unique(rows).tolist() if row not in own]
                for first in range(0, len(new), 2048):
                    own.update(zip(new[first : first + 2048], hashing.keys(units[new[first : first + 2048]])))
                return np.array([own[row] for row in rows.tolist()])

            def close(left, right):
                good = np.empty(len(left), dtype=bool)
                for first in range(0, len(left), 16384):
                    a, b = left[first : first + 16384], right[first : first + 16384]
                    good[first : first + 16384] = np.einsum("ij,ij->i", units[a], units[b]) >= cosine
                for first in range(0, int(good.sum()), 4096):
                    # A pair counts in the first table in which it meets.
                    a, b = left[good][first : first + 4096], right[good][first : first + 4096]
                    met = (of(a) == of(b)).argmax(axis=1)
                    here = of(a)[np.arange(len(a)), met] == keys[a]
                    np.add.at(totals, a[here], copies[b[here]])
                    np.add.at(totals, b[here], copies[a[here]])
                return good

            root = forest(len(frame), pairs(frame, close))
            moved = root != np.arange(len(frame))
            yield pd.DataFrame(
                {"node": item, "root": pd.array(np.where(moved, item[root], 0)).astype("Int64").copy(), "n": totals}
            ).assign(root=lambda x: x["root"].where(pd.Series(moved))).loc[moved | (totals > 0)]

    return dealt.mapInPandas(compare, "node long, root long, n long")
