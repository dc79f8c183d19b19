"""Connected components of an edge table, with edges and labels in stored tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sublens.llm.scratch import dropped, written


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").distinct()


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest one. Needs a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def component_labels(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, root of every node of an edge; root is the smallest node that edges lead to.

    ``edges`` has two columns, nodes of one comparable type; null ends are left out. Each round joins
    and aggregates edges by node; rounds are about the logarithm of the longest path. A node with many
    edges is pre-aggregated in the sums and split by adaptive execution in the joins.
    """
    a, b = edges.columns
    now = written(
        _distinct(
            edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
                F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
            )
        ),
        name,
    )
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            break
        mark = tuple(seen)
        after = written(_distinct(_small(_distinct(_large(now)))), name)
        dropped(now)
        now = after
    # at rest every node but a root has one edge, to its root
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
