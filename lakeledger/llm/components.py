"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps: every round hooks neighbours to
the smallest node they see, by a minimum for each node (reduced in the map
tasks) and a join that Spark can split on very common nodes.  The number of
rounds grows with the logarithm of the graph.  Rounds are checkpointed in the
shared folder; whether all components are stars is all that reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.util import cut

#: Edges in a partition.
EDGES = 500_000


def _finished(e: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one, which has none: each
    component is a star around its smallest node."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(
        e.select(F.col("v").alias("x"), F.lit(None).cast("int").alias("up")))
    node = ends.groupBy("x").agg(F.count("up").alias("ups"), F.count(F.lit(1)).alias("n"))
    return node.where("ups > 1 or (ups = 1 and n > 1)").isEmpty()


def _packed(e: DataFrame) -> DataFrame:
    """The same edges in as many partitions as their number needs."""
    return e.coalesce(max(1, -(-e.count() // EDGES)))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node with an edge, and the smallest node it is
    connected with.  Loops and null ends are ignored."""
    e = (edges.where(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = _packed(cut(e))
    while not _finished(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
            .alias("e")).select("e.*").where("u != v").distinct()
        e = _packed(cut(small))
    tree = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return tree.unionByName(tree.select(F.col("component").alias("node"), "component").distinct())
