"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked where few bits differ.

Links are found with pivot distance tables. The Hamming distances of every distinct fingerprint to reference
fingerprints (the pivots) are computed once and kept beside it. By the triangle inequality two fingerprints within r bits
differ by at most r in every coordinate, so a pair with a larger coordinate difference is discarded, and only survivors
are compared bit by bit.

Distances of unrelated fingerprints to a pivot lie close together (32 bits, give or take 4), so coordinates alone cannot
key a join: almost every pair would meet. Pairs therefore meet in buckets first. The 64 bits are cut into `radius + 2`
segments; fingerprints within `radius` bits agree in two segments at least, so a bucket for each pair of segments misses
no link. Large buckets are dealt into tiles (`buckets.tiles`), and a tile emits a spanning forest, not its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.buckets import forest, pairs, tiles
from lanewise.llm.common import partitions, texts, words_of
from lanewise.llm.components import components
from lanewise.llm.packing import whole_groups
from lanewise.sources import stage

SEED = 42
PIVOTS = 16


def shingle_hashes(text: str, shingle_words: int = 3) -> Iterator[np.ndarray]:
    """Hashes of a text's word shingles in their order, at most 65,536 at a time, so that a long text needs no more memory.

    A text of fewer words is one shingle; a text without words has none.
    """
    words = words_of(text)
    if not words:
        return
    line = b" ".join(words)
    starts, at = [], 0
    for word in words:
        starts.append(at)
        at += len(word) + 1
    n = max(1, len(words) - shingle_words + 1)
    ends = [start - 1 for start in starts[shingle_words:]] + [len(line)]
    digest = xxhash.xxh64_intdigest
    for first in range(0, n, 65536):
        yield np.array([digest(line[a:b], SEED) for a, b in zip(starts[first : min(n, first + 65536)], ends[first:])], dtype="<u8")


def fingerprint(text: str, shingle_words: int = 3) -> int:
    """The fingerprint as an unsigned integer; a text without words has 0."""
    ones, total = np.zeros(64, dtype=np.int64), 0
    for part in shingle_hashes(text, shingle_words):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(part)
    return int(np.packbits((2 * ones > total).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint long) per row, the fingerprint's 64 bits as a signed number.

    A missing or empty text has fingerprint 0. Rows are not merged: repeated ids give repeated rows.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = np.fromiter((fingerprint(x, shingle_words) for x in frame["text"]), np.uint64, len(frame))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "fingerprint": found.view(np.int64)})

    return texts(docs, id_col, text_col).mapInPandas(run, "doc_id long, fingerprint long")


def pivot_table(prints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances, a row per fingerprint and a column per pivot."""
    return np.bitwise_count(prints[:, None] ^ pivots[None, :])


def pivot_prints(n: int = PIVOTS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=np.uint64)


def segments(radius: int) -> list[np.ndarray]:
    """Masks of the bucket keys: all pairs of `radius + 2` segments."""
    edges = np.linspace(0, 64, radius + 3).round().astype(int)
    masks = [sum(1 << bit for bit in range(a, b)) for a, b in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(masks, 2)]


def links(prints: DataFrame, radius: int = 3, n_pivots: int = PIVOTS) -> DataFrame:
    """(a, b): links that connect every pair of distinct fingerprints within `radius` bits, directly or by others.

    `prints` has one column `fingerprint` of distinct values. Exact: no pair within the radius stays unconnected.
    """
    pivots, masks = pivot_prints(n_pivots), segments(radius)

    def coordinates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = frame["fingerprint"].to_numpy().astype(np.int64).view(np.uint64)
            rows = pivot_table(found, pivots).astype(np.uint8)
            yield pd.DataFrame({"fingerprint": frame["fingerprint"], "coordinates": [row.tobytes() for row in rows]})

    known = stage(prints.mapInPandas(coordinates, "fingerprint long, coordinates binary"), name="pivots")
    keys = F.array(
        *(
            F.struct(F.lit(i).alias("band"), F.col("fingerprint").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("bits"))
            for i, mask in enumerate(masks)
        )
    )
    rows = known.select("fingerprint", "coordinates", F.explode(keys).alias("key"))
    rows = rows.select("fingerprint", "coordinates", F.xxhash64("key.band", "key.bits").alias("key"))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, ["key", "tile"]):
            found = frame["fingerprint"].to_numpy().astype(np.int64)
            bits = found.view(np.uint64)
            table = np.frombuffer(b"".join(frame["coordinates"]), dtype=np.uint8).reshape(len(frame), -1).astype(np.int8)

            def close(left, right):
                kept = np.ones(len(left), dtype=bool)
                for column in table.T:
                    kept[kept] = np.abs(column[left[kept]] - column[right[kept]]) <= radius
                kept[kept] = np.bitwise_count(bits[left[kept]] ^ bits[right[kept]]) <= radius
                return kept

            root = forest(len(frame), pairs(frame, close))
            moved = root != np.arange(len(frame))
            yield pd.DataFrame({"a": found[moved], "b": found[root[moved]]})

    dealt = tiles(rows, "fingerprint")
    dealt = dealt.repartition(partitions(prints.sparkSession), "key", "tile").sortWithinPartitions("key", "tile", "fingerprint")
    return dealt.mapInPandas(compare, "a long, b long")


def groups(docs: DataFrame, radius: int = 3, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, root, component_id) per row of `docs`.

    component_id is the smallest doc_id of the rows that links connect, the row's own included. Rows of one fingerprint,
    so all copies of a text and all texts without words, are always in one component. A missing doc_id is never the
    smallest; a component without any doc_id has none. Repeated rows stay; an empty table gives an empty one.
    `root` is the fingerprint that stands for the component.
    """
    marked = stage(fingerprints(docs, shingle_words, id_col, text_col), name="fingerprints")
    return placed(marked, lambda found: links(found.select("fingerprint"), radius))


def placed(marked: DataFrame, linked: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`groups` for staged rows (doc_id, fingerprint) and a function from distinct (fingerprint, low) to links (a, b)."""
    found = stage(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("low")), name="prints")
    roots = components(linked(found), "a", "b")
    rooted = found.join(roots, found["fingerprint"] == roots["node"], "left")
    rooted = stage(rooted.select("fingerprint", "low", F.coalesce("root", "fingerprint").alias("root")), name="roots")
    lows = stage(rooted.groupBy("root").agg(F.min("low").alias("component_id")), name="components")
    known = stage(rooted.join(lows, "root").select("fingerprint", "root", "component_id"), name="placed")
    return marked.join(known, "fingerprint").select("doc_id", "fingerprint", "root", "component_id")


def keep_one(docs: DataFrame, radius: int = 3, shingle_words: int = 3) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the row with the smallest doc_id, all columns as they were.

    Where several rows have that doc_id, one of them stays. Rows without a doc_id go where their component has one; if
    none of its rows has one, one row stays.
    """
    return first_rows(docs, groups(docs, radius, shingle_words), lambda text: fingerprint(text, shingle_words))


def first_rows(docs: DataFrame, found: DataFrame, print_of: Callable[[str], int]) -> DataFrame:
    """The rows of `docs` that `keep_one` keeps, given their groups and the function that made the fingerprints.

    The ids that stay grow with the table, so they are never broadcast: rows and ids meet by a shuffle at any size.
    """
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = stage(first.groupBy("root", "doc_id").agg(F.count("*").alias("n")), name="keep")
    names = docs.columns
    alone = keep.where("n = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__llm_id")).hint("merge")
    single = docs.join(alone, docs["doc_id"].cast("long") == F.col("__llm_id"), "left_semi").select(*names)
    again = keep.where("n > 1 OR doc_id IS NULL").select(F.col("root").alias("__llm_root"), F.col("doc_id").alias("__llm_id"))
    if again.isEmpty():
        return single
    # Repeated ids are rare. Their rows are written first, so that only they are fingerprinted once more.
    roots = stage(found.select(F.col("fingerprint").alias("__llm_print"), F.col("root").alias("__llm_to")).distinct(), name="to")
    same_id = F.col("doc_id").cast("long").eqNullSafe(F.col("__llm_id"))
    several = stage(docs.join(again.select("__llm_id").distinct(), same_id, "left_semi"), name="several")
    several = several.withColumn("__llm_print", _print_column(print_of)).join(roots, "__llm_print")
    several = several.join(again, same_id & (F.col("__llm_to") == F.col("__llm_root")))
    return single.unionByName(several.dropDuplicates(["__llm_root"]).select(*names))


def _print_column(print_of: Callable[[str], int]):
    @F.pandas_udf("long")
    def run(text: pd.Series) -> pd.Series:
        found = (print_of(x if isinstance(x, str) else "") for x in text)
        return pd.Series(np.fromiter(found, np.uint64, len(text)).view(np.int64))

    return run(F.col("text"))
