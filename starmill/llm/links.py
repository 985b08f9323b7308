"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.session import stage


def state(links: DataFrame) -> tuple:
    """Equal states mean equal links, but for a collision of a 64-bit hash sum."""
    sums = links.agg(
        F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
    )
    return tuple(sums.first())


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``node, root``: for every node of ``a, b`` its component's least node, other than itself.

    Large-star and small-star steps in turn: every node hands its neighbours to the least among
    them. A step groups by node with partial aggregates and joins the minimum back, so a node
    with very many neighbours is split as a skewed join is. Steps are written to the shared
    folder.
    """
    links = stage(links.where("a <> b").select("a", "b").distinct(), "links")
    before = state(links)
    for _ in range(most_rounds):
        for larger in (True, False):
            both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            if not larger:
                both = both.where("b < a")
            least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("least"))
            least = least.select("n", F.least("n", "least").alias("least"))
            joined = both.join(least, F.col("a") == F.col("n"))
            if larger:
                joined = joined.where("b > a")
            moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
            if not larger:
                moved = moved.unionByName(least.select(F.col("n").alias("a"), F.col("least").alias("b")))
            links = stage(moved.where("a <> b").distinct(), "links")
        after = state(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
