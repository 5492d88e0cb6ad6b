"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import WorkTables


def _toward_minimum(work: WorkTables, edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest of u and its neighbours.

    The minima are a written table, so a hub's edges can be split in the join.
    """
    least = work.keep(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    return edges.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def components(work: WorkTables, links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``) that is not its component's smallest.

    Large-star hangs each node's larger neighbours below the node's smallest
    neighbour, small-star the smaller ones; both keep components as they are.
    It ends when a round changes nothing: then every edge leads to the root.
    """
    edges = work.keep(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_minimum(work, both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = work.keep(large.where("u > v").distinct(), "large")
        near = _toward_minimum(work, large)
        small = near.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = work.keep(small.where("u > v").distinct(), "small")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """What tells two edge tables apart: their count and two sums of hashes."""
    hashed = [F.sum(F.xxhash64(F.lit(seed), "u", "v").cast("decimal(38,0)")) for seed in (1, 2)]
    return tuple(edges.agg(F.count("*"), *hashed).first())
