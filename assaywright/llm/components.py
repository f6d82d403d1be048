"""Connected components of a graph of any size, by alternating large-star and small-star rounds.

Every round is stored in the shared folder, so a lost executor costs one round
at most.  Minima are partial aggregates and hubs are joined by ``join_keyed``,
so the edges of one node never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import ROWS, join_keyed
from ..operators.storage import stored
from .common import BROADCAST


def _with_least(edges: DataFrame, paths: list[str]) -> DataFrame:
    """Edges (u, v) with ``m``, the least of u and all v of u's edges."""
    least = edges.groupBy(F.col("u").alias("node")).agg(
        F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias(ROWS)
    )
    return join_keyed(edges, [F.col("u")], stored(least, paths), ["node"], BROADCAST, "inner", paths)


def _distinct(edges: DataFrame, paths: list[str]) -> DataFrame:
    return stored(edges.where("u <> v").distinct(), paths)


def components(edges: DataFrame, paths: list[str]) -> DataFrame:
    """From edges (u, v) of longs: ``node``, ``root`` for every node with an edge; root is the least node reachable.

    Loops and repeated edges are allowed; no edges give no rows.
    """
    edges = _distinct(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), paths)
    seen = None
    while True:
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, paths).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = _distinct(large, paths)
        small = _with_least(edges, paths).select("u", "v", "m")
        pairs = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        edges = _distinct(small.select(pairs.alias("e")).select("e.u", "e.v"), paths)
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return found.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
