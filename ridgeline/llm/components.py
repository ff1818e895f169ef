"""Connected components of a graph given by its links, without leaving DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of each node in ``links`` (a, b bigint); a component is named by its smallest node.

    Large-star and small-star steps in turn, each one aggregate and one join, until all links are stars; rounds grow with
    the logarithm of a component's diameter.  A hub is one aggregate row and a join that Spark can split.  Each round is
    written to the shared folder.
    """
    edges = written(links.select("a", "b").filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        first = written(least, "cc-least")
        large = both.join(first, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.filter("a != b").distinct(), "cc")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        least = written(least, "cc-least")
        small = large.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a != b")
        after = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
        for old in (edges, first, large, least):
            drop_written(old)
        edges = after
        # Done when each node has one target, and no target is a node with a target itself.
        twice = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
        onward = edges.select("a").join(edges.select(F.col("b").alias("t")).distinct(), F.col("a") == F.col("t"), "left_semi")
        if twice.unionByName(onward).isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
