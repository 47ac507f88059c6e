"""Connected components by rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, packed


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b) with the smallest node of its component.

    Each round points a node at its least neighbour, follows the pointers once and
    contracts the edges to the new nodes, until none is left.  Every round is a few
    joins; nothing but the number of edges reaches the driver.
    """
    left = keep(edges.select("a", "b").where("a <> b").distinct(), "edges")
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    roots = nodes.withColumn("root", F.col("node"))
    # later tables have no more rows than a few times these
    small = packed(left)
    while left.limit(1).count():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to"))
        point = keep(small(point), "pointers")
        onward = point.select(F.col("a").alias("to"), F.col("to").alias("next"))
        point = keep(small(point.join(onward, "to").select("a", F.col("next").alias("to"))), "pointers")
        of = point.select(F.col("a").alias("root"), "to")
        roots = keep(small(roots.join(of, "root", "left").select("node", F.coalesce("to", "root").alias("root"))), "roots")
        ends = left.join(point, "a").select("b", F.col("to").alias("x"))
        ends = ends.join(point.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        ends = ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        left = keep(small(ends), "edges")
    return roots
