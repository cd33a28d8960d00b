"""Connected components by alternating large-star and small-star steps, all on distributed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.sources import stage


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): for every node that stands in a link, the smallest node of its component.

    Links may repeat, run both ways or lead from a node to itself; an empty table gives an empty one. Every step is
    written to the shared folder, so a lost executor costs one step. The minimum per node is written before the join
    with it, so that Spark can split the rows of a node that has very many links. The driver sees three numbers a step.
    """
    flow = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u != v").distinct()
    flow = stage(flow, name="links")
    before = _state(flow)
    while before[0]:
        both = flow.unionByName(flow.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")), name="low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = stage(large.distinct(), name="large")
        low = stage(large.groupBy("u").agg(F.min("v").alias("low")), name="low")
        small = large.join(low, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        flow = stage(small.unionByName(low.select("u", F.col("low").alias("v"))).distinct(), name="links")
        after = _state(flow)
        if after == before:
            break
        before = after
    nodes = flow.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(flow.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
