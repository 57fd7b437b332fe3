"""Connected components of an edge table, by Spark joins and aggregations over written tables."""

from pyspark.sql import functions as F

from ..session import materialize


def components(edges):
    """(node, root) for each node of ``edges`` (a, b): root is the least node of its component.

    Each round, in the manner of large and small stars, links every node to the least node it has an edge with; the
    rounds grow with the logarithm of a component's size. Every round is a written table.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges, state = materialize(edges, "edges"), None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: the greater neighbours of a node move to its least neighbour.
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.filter("m < a").select("a", F.col("m").alias("b"))
        large = large.unionAll(own).filter("a <> b").distinct()
        # Small star: the lesser neighbours of a node, and the node, move to the least of them.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = moved.unionAll(lowest.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        small = materialize(small, "edges")
        before, state, edges = state, small.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first(), small
        if state == before:
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
