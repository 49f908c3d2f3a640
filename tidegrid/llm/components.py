"""Connected components of links that no single machine could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.session import stage
from tidegrid.tiles import lookup

MAX_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node that occurs in ``links``.

    Alternates two steps until nothing changes: every node passes the smallest node it knows to its larger neighbours, then to its
    smaller ones.  Stars grow while paths shorten, so the rounds grow with the logarithm of the longest path.  Minima are
    aggregated before the shuffle; every round is written to the shared folder, so lineage stays short.
    """
    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x <> y")
    edges = stage(pairs.select(F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high")).distinct(), "components-edges")
    nodes = edges.select(F.col("low").alias("node")).union(edges.select("high")).distinct()
    for _ in range(MAX_ROUNDS):
        if _are_stars(edges):
            break
        # large star: the larger neighbours of a node are tied to the smallest node around it
        both = edges.unionByName(edges.select(F.col("high").alias("low"), F.col("low").alias("high")))
        least = both.groupBy("low").agg(F.min("high").alias("m")).select("low", F.least("low", "m").alias("m"))
        upward = lookup(edges, least, ["low"], salt_by=["high"], how="inner")
        large = upward.select(F.col("m").alias("low"), "high").filter("low <> high").distinct()
        large = stage(large, "components-large")
        # small star: a node and its smaller neighbours are tied to the smallest of them
        low = large.groupBy(F.col("high").alias("center")).agg(F.min("low").alias("m"))
        tied = large.join(low, F.col("high") == F.col("center")).select(F.col("m"), F.explode(F.array("low", "high")).alias("high"))
        edges = stage(tied.filter("m <> high").select(F.col("m").alias("low"), "high").distinct(), "components-edges")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    found = edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _are_stars(edges: DataFrame) -> bool:
    """Every node is either a center or has one center: nothing is left to do."""
    ends = edges.select(F.col("low").alias("node"), F.lit(0).alias("high")).union(edges.select("high", F.lit(1)))
    odd = ends.groupBy("node").agg(F.sum("high").alias("centers"), F.count(F.lit(1)).alias("n")).filter("centers > 1 OR (centers = 1 AND n > 1)")
    return odd.count() == 0
