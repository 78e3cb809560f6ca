"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import handover


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(a, b); component is the least node reachable.

    Alternating large and small stars: each round hangs every node under a smaller neighbour, so
    the number of rounds grows with the logarithm of the longest chain. A node's neighbours are
    only ever reduced to their minimum or joined row by row, never gathered. Each round is
    written to the shared folder.
    """
    links = handover(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        state = links.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v"))
        ).first()
        if state == before or state[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                links.select("v", "v").distinct()
            )
        before = state
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select("v", "m").union(least.select("u", "m"))
        links = handover(small.toDF("u", "v").distinct(), "links")
