"""Merkle manifest of a table: a digest per row, a tree of digests per group, one tree over the groups, and a proof per row.

The trees are built by time-forward processing. Nodes are labelled so that children come before their parent; a node's digest
is put into a priority queue under its parent's label and is taken out when the sweep gets there. Between blocks of the trees
the queue is external: digests of block roots are written to storage and dealt out by a shuffle sorted by label. In a block,
whose size is fixed, a heap holds what is on its way. A reversed sweep then hands each node the siblings that lie on its
way to the root: top blocks first, leaves last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewise.llm.common import partitions
from lanewise.llm.packing import whole_groups
from lanewise.sources import stage

#: Children of a node, and levels of a block: a task holds the FANOUT ** LEVELS entries of one block at a time.
FANOUT, LEVELS = 8, 4
BLOCK = FANOUT**LEVELS

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PROOF = "array<struct<left string, right string>>"


def field(value: Column) -> Column:
    """`-` for null, else the bytes of the value as text, `:` and the text, so that no two rows give the same input."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    """The digest of a row, as hex."""
    return F.sha2(F.concat(*[field(column) for column in columns]).cast("binary"), 256)


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- positions -------------------------------------------------------------------------------------------------


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with `pos`, counting from 0 in the order of `order` (nulls first) within `group`, and `n`, the group's rows.

    Rows are dealt out by ranges, so a group of any size is spread over tasks; rows that are equal are spread by a number of
    their own, as any order of them is right. Only the first row number of each group and task is gathered to count on from.
    """
    spark = rows.sparkSession
    keys = [F.col(name).asc_nulls_first() for name in (group, *order)]
    even = F.xxhash64(F.monotonically_increasing_id())
    dealt = rows.withColumn("__even", even).repartitionByRange(partitions(spark), *keys, F.col("__even")).drop("__even")
    placed = dealt.sortWithinPartitions(*keys).withColumn("__row", F.monotonically_increasing_id())
    placed = stage(placed, name="leaves")
    part = F.shiftright("__row", 33)
    runs = placed.groupBy(group, part.alias("__part")).agg(F.count("*").alias("rows"), F.min("__row").alias("first"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("rows").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col(group).alias("__group"), "__part", (before - F.col("first")).alias("__shift"), F.sum("rows").over(whole).alias("n"))
    runs = stage(runs, name="runs").withColumnRenamed("__part", "__of")
    joined = placed.withColumn("__part", part).join(runs, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__of")))
    return joined.withColumn("pos", F.col("__row") + F.col("__shift")).drop("__row", "__part", "__of", "__group", "__shift")


# --- sweeps in a block -----------------------------------------------------------------------------------------


def levels_of(n: int) -> int:
    """Levels above a group's entries in its blocks: until one node is left, LEVELS at most."""
    levels = 0
    while n > 1 and levels < LEVELS:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def sweep_up(entries: list[str], levels: int) -> list[list[str]]:
    """The digests of a block's nodes, level by level from its entries. Labels are (level, place)."""
    nodes = [list(entries), *([] for _ in range(levels))]
    queue = [(1, place // FANOUT, place, value) for place, value in enumerate(entries)] if levels else []
    heapify(queue)
    while queue:
        level, at = queue[0][:2]
        inputs = []
        while queue and queue[0][:2] == (level, at):
            inputs.append(heappop(queue)[3])
        nodes[level].append(digest(inputs))
        if level < levels:
            heappush(queue, (level + 1, at // FANOUT, at, nodes[level][-1]))
    return nodes


def sweep_down(nodes: list[list[str]], suffix: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """The proof of each entry: what stands left and right of it in its run, then of its parent, on to `suffix` of the block."""
    proofs: list[list[tuple[str, str]]] = [[] for _ in nodes[0]]
    queue = [(1 - len(nodes), 0, suffix)]
    while queue:
        level, at, proof = heappop(queue)
        if level == 0:
            proofs[at] = proof
            continue
        below = nodes[-level - 1]
        first = at * FANOUT
        run = below[first : first + FANOUT]
        for i in range(len(run)):
            heappush(queue, (level + 1, first + i, [("".join(run[:i]), "".join(run[i + 1 :])), *proof]))
    return proofs


# --- sweeps over blocks ----------------------------------------------------------------------------------------


def _forward(entries: DataFrame, leaves: bool) -> DataFrame:
    """The blocks of (g, pos, n, digest), one row each: its root, and its entries for the way back; ids and claims of leaves."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marked = (frame.assign(none=frame["g"].isna(), name=frame["g"].fillna("")) for frame in frames)  # null equals null here
        for frame in whole_groups(marked, ["none", "name", "block"]):
            out = []
            for _, block in frame.groupby(["none", "name", "block"], sort=False):
                values = block["digest"].tolist()
                top = sweep_up([value.hex() for value in values], levels_of(int(block["n"].iloc[0])))[-1][0]
                row = [block["g"].iloc[0], block["block"].iloc[0], block["n"].iloc[0], bytes.fromhex(top), b"".join(values)]
                if leaves:
                    row += [b"".join(block["claim"]), block["id"].to_numpy(np.int64).tobytes(), (~block["present"].to_numpy(bool)).astype(np.uint8).tobytes()]
                out.append(row)
            yield pd.DataFrame(out, columns=names)

    names = ["g", "block", "n", "root", "entries"] + (["claims", "ids", "nulls"] if leaves else [])
    kinds = ["string", "long", "long", "binary", "binary"] + (["binary"] * 3 if leaves else [])
    spark = entries.sparkSession
    dealt = entries.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
    dealt = dealt.repartition(partitions(spark), "g", "block").sortWithinPartitions("g", "block", "pos")
    return stage(dealt.mapInPandas(run, ", ".join(f"{a} {b}" for a, b in zip(names, kinds))), name="blocks")


def _rounds(entries: DataFrame, leaves: bool) -> list[DataFrame]:
    """Rounds from the entries up to one block per group; each takes the block roots of the one before as its entries."""
    found = [_forward(entries, leaves)]
    most = found[0].agg(F.max("n")).first()[0] or 0
    while most > BLOCK:
        most = -(-most // BLOCK)
        above = found[-1].select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("root").alias("digest"))
        found.append(_forward(above, False))
    return found


def _with_suffix(blocks: DataFrame, suffixes: DataFrame, on: list[str]) -> DataFrame:
    side = suffixes.withColumnsRenamed({name: f"__{name}" for name in on})
    same = F.lit(True)
    for name in on:
        same = same & F.col(name).eqNullSafe(F.col(f"__{name}"))
    return blocks.join(side, same).drop(*[f"__{name}" for name in on])


def _hexes(data: bytes) -> list[str]:
    text = data.hex()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def _backward(blocks: DataFrame, leaves: bool) -> DataFrame:
    """(g, pos, proof) of the entries of blocks that know the `suffix` of their root; for leaves their columns too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values = _hexes(row["entries"])
                nodes = sweep_up(values, levels_of(row["n"]))
                proofs = sweep_down(nodes, [(step["left"], step["right"]) for step in row["suffix"]])
                steps = [step for proof in proofs for step in proof]
                offsets = np.concatenate([[0], np.cumsum([len(proof) for proof in proofs])]).astype(np.int32)
                sides = pa.StructArray.from_arrays([pa.array([s[i] for s in steps], pa.string()) for i in (0, 1)], names=["left", "right"])
                out = {"proof": pa.ListArray.from_arrays(offsets, sides), "g": pa.array([row["g"]] * len(values), pa.string())}
                if leaves:
                    ids, nulls = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["nulls"], np.uint8).astype(bool)
                    out |= {"doc_id": pa.array(ids, mask=nulls), "leaf": pa.array(values), "claim": pa.array(_hexes(row["claims"]))}
                    out |= {name: pa.array([row[name]] * len(values), pa.string()) for name in ("subroot", "top")}
                else:
                    out["pos"] = pa.array(np.arange(len(values)) + row["block"] * BLOCK)
                yield pa.RecordBatch.from_arrays([out[name] for name in names], names=names)

    names = ["doc_id", "g", "leaf", "claim", "subroot", "top", "proof"] if leaves else ["g", "pos", "proof"]
    kinds = {"doc_id": "long", "pos": "long", "proof": _PROOF}
    return blocks.mapInArrow(run, ", ".join(f"{name} {kinds.get(name, 'string')}" for name in names))


def _proofs(rounds: list[DataFrame], top: DataFrame, on_top: list[str]) -> DataFrame:
    """From the suffix of each group's root down to the blocks of the first round, each with its `suffix`."""
    carried = [name for name in top.columns if name not in ("g", "suffix")]
    blocks = _with_suffix(rounds[-1], top, on_top)
    for below in reversed(rounds[:-1]):
        found = _backward(blocks.drop(*carried), False)
        suffixes = stage(found.select("g", F.col("pos").alias("block"), F.col("proof").alias("suffix")), name="suffixes")
        blocks = _with_suffix(below, suffixes, ["g", "block"])
        if carried:
            blocks = _with_suffix(blocks, top.drop("suffix"), on_top)
    return blocks


# --- manifest --------------------------------------------------------------------------------------------------


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang", claim: Column | None = None) -> DataFrame:
    """(doc_id, <group>, leaf, claim, subroot, root, proof) per row of `docs`.

    leaf      digest of the row's `columns`
    claim     digest that the row is presented with, as hex; without `claim`, the leaf
    subroot   root of the tree over the leaves of the row's group, which stand by id
    root      root of the tree over all subroots, which stand by group
    proof     per level up to the root, the digests left and right of the row's node in its run of 8, joined

    A run is hashed also if it holds one node, as long as its level holds several; a tree of one leaf is that leaf. Nulls
    stand first: rows without an id, and the group without a value. Rows of one id stand by leaf; repeated rows have a leaf
    each, whose proofs differ by place. Long texts are hashed as a whole where they are read and never moved. An empty table
    gives an empty one. Other columns of `docs` are not read.

    A block of 4096 entries is what a task holds at once, whatever the size of a group; a shuffle moves digests and ids.
    """
    row = leaf([F.col(name) for name in columns])
    claimed = row if claim is None else F.coalesce(claim, row)
    key = F.col(id_col).cast("long")
    rows = docs.select(
        key.isNotNull().alias("present"),
        F.coalesce(key, F.lit(0)).alias("id"),
        F.col(group_col).cast("string").alias("g"),
        F.unhex(row).alias("digest"),
        F.unhex(claimed).alias("claim"),
    )
    rounds = _rounds(numbered(rows, "g", ["present", "id", "digest"]), True)
    subroots = rounds[-1].select("g", "root")

    entries = numbered(subroots.select(F.lit("").alias("all"), "g", F.col("root").alias("digest")), "all", ["g"])
    entries = stage(entries, name="subroots")
    over = _rounds(entries.select(F.col("all").alias("g"), "pos", "n", "digest"), False)
    root = over[-1].select("g", F.lower(F.hex("root")).alias("top"))
    none = F.array().cast(_PROOF)
    found = _backward(_proofs(over, root.select("g", none.alias("suffix")), ["g"]), False)
    places = entries.select("g", "pos", F.lower(F.hex("digest")).alias("subroot"))
    tops = found.join(root.select(F.col("g").alias("r"), "top"), F.col("g") == F.col("r")).select("pos", F.col("proof").alias("suffix"), "top")
    tops = stage(places.join(tops, "pos").select("g", "subroot", "top", "suffix"), name="tops")

    out = _backward(_proofs(rounds, tops, ["g"]), True)
    return out.withColumnsRenamed({"g": group_col, "top": "root"})


def folded(claim: Column, proof: Column) -> Column:
    """The root that a leaf's digest leads to with the digests of its proof."""
    return F.aggregate(proof, claim, lambda value, step: F.sha2(F.concat(step["left"], value, step["right"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf's level up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "").cast("binary"), 256)
