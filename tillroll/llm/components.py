"""Connected components of a table of links, as joins and groupings only.

Large-star and small-star steps alternate (Kiveris et al., "Connected
Components in MapReduce and Beyond"). Each round is written to the work folder,
so that no lineage grows and a lost executor costs one re-read. The driver sees
two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.sources.workspace import land


def _print(edges: DataFrame) -> tuple:
    """Number of links and a sum of their hashes: equal only for equal sets (up to 64-bit luck)."""
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def _least_neighbour(edges: DataFrame) -> DataFrame:
    # Landed, so that the joins below shuffle both sides for the join alone and
    # adaptive execution can split the partition of a hub.
    return land(edges.groupBy("u").agg(F.min("v").alias("m")), "least")


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): each linked node with the smallest node that it reaches.

    Nodes without a link are not listed. Loops, repeated links, links in both
    directions and an empty table are allowed; links with a null end are ignored.
    """
    a, b = F.col(left), F.col(right)
    edges = (
        links.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    edges = land(edges, "links")
    seen = _print(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least_neighbour(both)
        large = land(
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct(),
            "large",
        )
        least = _least_neighbour(large)
        small = (
            large.join(least, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = land(small, "small")
        now = _print(edges)
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(edges.select(F.col("v"), F.col("v"))).distinct()
