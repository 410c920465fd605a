"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.sources.scratch import durable

MAX_ROUNDS = 60


def _flipped(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("v").alias("u"), F.col("u").alias("v"))


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Link neighbours to the smallest one. ``edges`` holds u > v; so does the result.

    Minimums combine map-side, and are stored so that both sides of the join are plain shuffles, which skew handling may
    split: a hub with most of the nodes costs no more than other rows.
    """
    if small:
        least = durable(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        out = edges.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.union(least.select("u", F.col("m").alias("v")))
    else:
        both = edges.union(_flipped(edges))
        least = durable(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        out = both.filter("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.union(least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long) to (node, root), root the smallest node reachable; nodes without a link are absent.

    Lineage is cut in the shared folder after every round. The number of rounds grows with the logarithm of the longest
    path.
    """
    edges = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct())
    edges = durable(edges, "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        edges = durable(_star(durable(_star(edges, False), "large-star"), True), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(now)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
