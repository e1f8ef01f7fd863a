"""Connected components of a large graph, by alternating star contractions over stored edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.sources.scratch import staged


def _stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one edge and no ``v`` is a ``u``; as ``u > v``, each ``v`` is then its component's smallest node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that has a link; the component is its smallest node.

    Each round sends neighbours to smaller ones until only stars are left,
    in about the logarithm of the longest path; no round is spent on finding
    that nothing changes. Minima are aggregated before
    the shuffle, and joins on a node with very many links can be split, so a
    hub needs no large task. Loops and repeated links do not matter.
    """
    pair = links.where(F.col(a) != F.col(b))
    pair = pair.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = staged(pair, "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(down.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
