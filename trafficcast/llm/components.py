"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficcast.session import discard, staged


def _same(links: DataFrame, before: DataFrame) -> bool:
    """Whether two tables of distinct links hold the same ones."""
    return links.count() == before.count() and links.join(before, ["u", "v"], "left_anti").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link to another; root is the smallest node of its component.

    `edges` has u and v of one orderable type. Alternates two steps until nothing changes, each a
    grouped minimum and a join, so that a node with very many links is never gathered in one place:
    every node points its larger neighbours to the smallest one, then its smaller neighbours and
    itself. The number of rounds grows with the logarithm of the longest path. Each round is written
    to the shared folder, so a lost executor costs one round at most; the round before it then goes.
    """
    links = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = staged(links.distinct(), "links")
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        before, links = links, staged(small, "links")
        done = _same(links, before)
        discard(before)
        if done:
            return links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).union(
                links.select("v", F.col("v").alias("r")).distinct()
            )
