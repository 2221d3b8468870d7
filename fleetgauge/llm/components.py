"""Connected components by alternating stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pinned


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """`edges` (low, high; any order, repeats and loops allowed) to (node, component): the
    smallest node reachable, for every node with an edge to another.

    Each round sends the larger neighbours of a node, then the smaller ones, to the smallest
    neighbour; rounds grow with the logarithm of the component's size. Every round is a written
    table, so lineage stays short and a lost executor costs one round. No edges: no rows."""
    pairs = edges.where("low <> high").select(
        F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")
    )
    pairs = pinned(pairs.distinct())
    state = _state(pairs)
    while state[0]:
        both = pairs.select(F.col("low").alias("node"), F.col("low").alias("next")).union(
            pairs.select(F.col("high").alias("node"), F.col("low").alias("next"))
        )
        smallest = both.groupBy("node").agg(F.min("next").alias("least"))
        wide = (
            pairs.join(smallest.withColumnRenamed("node", "low"), "low")
            .select(F.col("least").alias("low"), "high")
            .where("low <> high")
            .distinct()
        )
        below = wide.groupBy("high").agg(F.min("low").alias("least"))
        joined = wide.join(below, "high")
        tight = (
            joined.select(F.col("least").alias("low"), F.col("low").alias("high"))
            .union(joined.select(F.col("least").alias("low"), "high"))
            .where("low <> high")
            .distinct()
        )
        pairs = pinned(tight)
        after = _state(pairs)
        if after == state:
            break
        state = after
    return pairs.select(F.col("high").alias("node"), F.col("low").alias("component"))
