"""Connected components by alternating large-star and small-star steps.

Every step replaces an edge by one to the smallest neighbour, so hubs lose their edges
to a star around the component's smallest node; the edges are written to the shared
folder after each round. The smallest neighbour is an aggregate with map-side combine
and the join on it is a plain equi-join, so a hub with very many links is only a skewed
join side. Nodes are non-null longs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stored


def _star(edges: DataFrame) -> DataFrame:
    """Edges (u, v), u linked to its neighbours v: v -> smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    joined = edges.join(least, "u")
    return joined


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (node, root) for every node that has a link; root: its smallest node."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen:
            break
        seen = mark
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _star(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = _star(down)
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            small.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        now = stored(small.filter("a > b").distinct(), "cc")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
