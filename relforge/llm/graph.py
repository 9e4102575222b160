"""Connected components as repeated Spark joins (alternating large-star and small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return linked.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch, label: str, max_rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of ``edges`` (u, v: long); comp is the smallest node reachable.

    A round keeps the number of edges in bounds and halves distances at least, so a component of n
    nodes needs O(log^2 n) rounds. No round groups the edges of a whole component: rows are grouped
    by node with a partial aggregate, then joined, so a node with very many edges is split by AQE.
    """
    current = scratch.stage(_small_star(_large_star(edges)), f"{label}-0")
    state = None
    for i in range(1, max_rounds):
        after = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == tuple(after):
            break
        state = tuple(after)
        current = scratch.stage(_small_star(_large_star(current)), f"{label}-{i}")
        scratch.drop(f"{label}-{i - 1}")
    else:
        raise RuntimeError("connected components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots)
