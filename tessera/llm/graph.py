"""Connected components by alternating large and small stars over written tables.

Each step replaces edges so that every node moves to the smallest id it can see; the number of steps grows with the
logarithm of the longest path. Minima are combined before the shuffle; the join that hands them out has written tables on
both sides, so that adaptive execution can split the edges of a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch


def _star(scratch: Scratch, edges: DataFrame, large: bool) -> DataFrame:
    """large: links every larger neighbour to the smallest node near u; else every smaller one, and u itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = both if large else both.where("v < u")
    least = scratch.table(seen.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    near = (both.where("v > u") if large else seen).join(least, "u")
    out = near.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return scratch.table(out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first())


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root): the smallest id of the node's component, for every node but the roots themselves. Null ends are ignored."""
    scratch = Scratch(edges.sparkSession, "components")
    now = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v")
    now, mark = scratch.table(now.distinct(), "edges"), None
    while (new := _mark(now)) != mark:
        mark = new
        now = _star(scratch, _star(scratch, now, large=True), large=False)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
