"""Connected components of a graph given by its edges.

Rounds of two steps each, as in the alternating algorithm of Kiveris et al.
("Connected Components in MapReduce and Beyond", 2014): every node links its
larger neighbours to its smallest one, then its smaller neighbours likewise.
Both are joins with a minimum per node, so a node with very many neighbours is
summed up in the tasks and, as a hot join key, split by adaptive execution. A
long chain halves in every round. Each round's edges are written to the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stormfare.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (a, b); component is the smallest node."""
    pairs = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(),
        "component-edges",
    )
    while not pairs.isEmpty():
        both = pairs.select("v", "u").union(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        smallest = both.groupBy("v").agg(F.min(F.least("v", "u")).alias("m"))
        # Larger neighbours go to the smallest neighbour (or the node itself, if it is smaller).
        large = written(
            pairs.select(F.col("u").alias("v"), F.col("v").alias("w")).join(smallest, "v")
            .select(F.col("w").alias("v"), F.col("m").alias("u")).filter("v <> u").distinct(),
            "component-large",
        )
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        linked = large.join(least, "v")
        small = written(
            linked.select(F.col("u").alias("v"), F.col("m").alias("u")).filter("v <> u")
            .union(least.select("v", F.col("m").alias("u"))).distinct(),
            "component-small",
        )
        # Done when all edges lead straight to a node without a smaller one.
        open_ = small.select("v").intersect(small.select(F.col("u").alias("v")))
        many = small.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        changed = not open_.isEmpty() or not many.isEmpty()
        pairs = small
        if not changed:
            break
    return pairs.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        pairs.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
