"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from medallion.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest neighbour (or the node itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie every smaller-or-equal neighbour of a node, and the node, to the smallest neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(least, "a").select(F.col("m").alias("a"), "b")
            .union(least.select(F.col("m").alias("a"), F.col("a").alias("b"))))


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id in a link ``a, b`` of two different ids; a component's id is its smallest.

    Both star steps keep the components and lower the ties; the loop ends when no tie changes.  Each round is
    stored in the shared folder.  Ids without a link are not returned; an empty table gives none.
    """
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    state = None
    while True:
        for star in (_large_star, _small_star):
            edges = star(edges).where("a != b").distinct()
        seen = Observation()  # a retried task reports again at most, which costs a further round
        edges = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("ties")))
        found = (seen.get["n"], seen.get["ties"])
        if found == state or not found[0]:
            break
        state = found
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).union(
        edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())
