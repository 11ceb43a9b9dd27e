"""Connected components of a graph given as edges, in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm import tables
from tidewheel.llm.tables import stored, with_fact

#: A node of fewer neighbours is no hub.
HUB = 1000


def _round(edges: DataFrame, count: int) -> DataFrame:
    """Each node's larger neighbours go to its smallest one, then its smaller ones do (large star, small star).

    ``count`` is the number of edges. The smallest neighbours of hubs, of which there are 2 * ``HEAVY`` at most, are
    broadcast, so a hub's edges stay dealt over tasks.
    """
    hub = F.col("degree") > max(HUB, count // tables.HEAVY)
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count(F.lit(1)).alias("degree"))
    large = with_fact(both.where("b > a"), least, "a", "m", hub, "b").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    # all edges now go from the larger node (a) to the smaller one (b)
    low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))
    small = with_fact(large, low, "a", "m", hub, "b")
    return (
        small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).distinct()
    )


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of an edge, root being the smallest node it is connected with.

    ``edges`` has the long columns a and b; direction, loops and repeats don't matter. The number of rounds grows
    as the logarithm of the longest path; what a round makes is at most the edges and nodes it got.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    before = _print(edges)
    while before[0]:
        edges = stored(_round(edges, before[0]), "edges")
        now = _print(edges)
        if now == before:
            break
        before = now
    # every edge now leads from a node to its root
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
