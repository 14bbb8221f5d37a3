"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.tables import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``(id, root)`` for every id of ``links`` (``a``, ``b``): the smallest id it is linked with, itself included.

    In each round every node hands its neighbours the smallest id it sees; the
    minima are merged map-side, so the centre of a large star arrives as one row
    per task. The edges are written once per round, and the rounds end when they
    stay the same, after about the logarithm of the longest path.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    edges = materialize(edges.distinct())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return materialize(
                edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
                .union(edges.select("v", "v"))
                .groupBy("id")
                .agg(F.min("root").alias("root"))
            )
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        # To a node's smallest neighbour: the node, and its other smaller neighbours.
        pairs = small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = materialize(pairs.where("u <> v").distinct())
