"""Connected components by alternating star contraction, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediabatch.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) to (node, root): the smallest node of its component, for every node of an edge.

    A large-star step links a node's larger neighbours to its smallest one, a small-star step its smaller neighbours and
    itself. They are repeated until nothing changes; what is left are stars. Each step's result is written.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    links = stored(edges.select(high.alias("a"), low.alias("b")).filter("a <> b").distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a <> b").distinct(), "links")
        # Now a > b in every row: a node's smaller neighbours are its b.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        star = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        star = stored(star.filter("a <> b").distinct(), "links")
        # Done when every node has one smaller neighbour and that neighbour has none.
        roots = star.select(F.col("b").alias("a")).distinct()
        if star.join(roots, "a", "left_semi").isEmpty() and star.groupBy("a").count().filter("count > 1").isEmpty():
            links = star
            break
        links = star
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
