"""Connected components by alternating large-star and small-star.

Both steps are joins and aggregates over the edges, cut by written tables; no node's
neighbours are ever gathered. A node with very many neighbours is summed by partial
aggregation, and the join that meets them with its minimum can be split.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.session import stage


def _large_star(edges):
    """Every larger neighbour of u is tied to the smallest of u and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = both.where("v > u").join(least, "u")
    # Repeated edges go with the next step.
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges):
    """u and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges):
    """Whether every node hangs on one root, and no root hangs on another."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("roots")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("roots")))).alias("end")).select("end.*")
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("roots").alias("roots"))
    return (nodes.agg(F.max(F.col("hangs") + F.col("roots"))).first()[0] or 1) == 1


def connected_components(edges: DataFrame, u="u", v="v") -> DataFrame:
    """(node, component) for every node that has an edge to another; the component is
    its smallest node. Repeated edges, loops and both directions are fine. The edges are
    read several times: pass a written table."""
    larger, smaller = F.greatest(F.col(u), F.col(v)), F.least(F.col(u), F.col(v))
    now = edges.where(F.col(u) != F.col(v)).select(larger.alias("u"), smaller.alias("v"))
    while not _settled(now):
        now = stage(_small_star(_large_star(now)), "edges")
    # Now each node hangs on its root.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
