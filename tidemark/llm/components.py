"""Connected components of a graph given as links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep



def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    joined = both.join(least, "a").filter(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return moved.unionByName(own).filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links(a, b)``; the least node names it.

    A round of a large and a small star at least halves the height of each
    component's tree; rounds go on until every link leads to a root. Minima are
    combined before they are shuffled, so a node with many links is no burden.
    """
    links = keep(links.filter(F.col("a") != F.col("b")).select("a", "b"))
    while True:
        links = keep(_small_star(_large_star(links)))
        # All links lead down, so the roots are the ends that are no beginnings; the
        # forest is flat when each node has one link and none leads to a node.
        ends = links.groupBy("a").agg(F.count("*").alias("n"), F.lit(False).alias("root"))
        roots = links.groupBy(F.col("b").alias("a")).agg(F.lit(0).alias("n"), F.lit(True).alias("root"))
        both = ends.unionByName(roots).groupBy("a")
        both = both.agg(F.max("n").alias("n"), F.max("root").alias("root"))
        if both.filter((F.col("n") > 1) | ((F.col("n") == 1) & F.col("root"))).isEmpty():
            break
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return keep(nodes.unionByName(roots))
