"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mcrunstat.llm.common import stored


def _large(edges: DataFrame) -> DataFrame:
    """Every neighbour above u is linked to the least of u's neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Every neighbour below u, and u, is linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node of its component) for every node with a link;
    ``edges`` has long columns u and v in any order, repeats and loops allowed.

    Each round is written to the shared folder; rounds grow with the logarithm of the
    longest chain, and no round makes more links than it was given nodes and links.
    """
    now = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), "links")
    state = None
    while True:
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (sums[0], sums[1]) == state:
            break
        state = (sums[0], sums[1])
        if not sums[0]:
            break
        large = _large(now).filter("u != v").distinct()
        now = stored(_small(large).filter("u != v").distinct(), "links")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
