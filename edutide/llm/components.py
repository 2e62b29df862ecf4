"""Connected components by alternating large-star and small-star steps; every step is a partial aggregate and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of the node and its neighbours."""
    sym = _both_ways(edges)
    least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return sym.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of these neighbours. u > v in each edge."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, what: str = "components") -> DataFrame:
    """edges (u, v), of one ordered type; returns (node, component): every node of an edge and the smallest node it reaches.

    Self loops, repeated edges and both directions are fine; edges with a null end are ignored; no edges give no rows.
    Hot nodes are pre-aggregated (a minimum) and their edges can be split by Spark's skew join.
    """
    now = stored(edges.where("u is not null and v is not null and u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), what)
    mark = None
    while True:
        size = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if size["n"] == 0 or (size["n"], size["h"]) == mark:
            break
        mark = (size["n"], size["h"])
        now = stored(_small_star(_large_star(now).distinct()).distinct(), what)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v")).distinct()
