"""Connected components of a distributed edge list.

Alternates two steps until nothing changes: every node links its larger
neighbours to its smallest neighbour (large star), then its smaller neighbours
and itself (small star).  The edge list never grows, the number of rounds is
logarithmic in practice, and a node with very many neighbours is only ever
reduced by a partial minimum and joined by a join that can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _sum(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], int(r["h"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest
    node it can reach.  Self-links are allowed; nulls are not."""
    edges = stage(edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _sum(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # every edge points from the larger node to the smaller one
        large = stage(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = stage(small.where("u != v").distinct(), "edges")
        before, state = state, _sum(edges)
        if before == state:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
