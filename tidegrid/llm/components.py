"""Connected components of a graph given as pairs of numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import stored


def star_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root``: for every node that has an edge and is not a root, the smallest node of its component.

    Alternates the two star operations until the edges are stars: every neighbour larger than a
    node is linked to the smallest neighbour of that node, then every smaller neighbour is. They are stars when no node with a
    smaller neighbour has another edge. Each round is grouped with partial minima and written to the shared folder;
    nothing is gathered per node, so a node may have any number of edges. Nulls and loops are ignored.
    """
    now = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    now = stored(now.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") > F.col("lo"))).distinct(), "edges")
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(now.select("lo", "hi"))
        nodes = stored(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("edges")), "nodes")
        if nodes.filter("m < u and edges > 1").isEmpty():
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        large = both.filter("v > u").join(nodes, "u").select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = stored(small.unionAll(least.select("hi", "m")).distinct(), "edges")
