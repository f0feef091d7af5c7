"""Connected components of a graph in Spark, by stars that grow and shrink in turn."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.text import discard, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour or itself."""
    ways = _both_ways(edges)
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return ways.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the least of them. Edges lead to the smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.unionByName(least.select("a", F.col("least").alias("b"))).where("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """`node, component` for every node of the edges `(a, b)`; a component is named by its least node.

    Both steps keep the components and bring every node nearer to the least one; the number of rounds
    grows with the logarithm of the longest path. Each round is written to the shared folder, and only
    a count and a sum come to the driver.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges, before = stored(edges, "components"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        nearer = stored(_small_star(_large_star(edges)).distinct(), "components")
        discard(edges)
        edges = nearer
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
